"""A corpus from documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm import credentials, mixing, packing, queries, simhash, toxicity
from tollbook.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine rejects go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one of the smallest id."""
    return simhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and linked credential parts are replaced in the texts; every document stays."""
    return credentials.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, by weight, each document at most once."""
    budget = F.floor(F.sum("supply") * 4 / 5)
    return mixing.mix_documents(docs, queries.mix_domain(), queries.mix_weights(), budget, 1)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Neither the learned scores nor the tokenizer can be written in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
