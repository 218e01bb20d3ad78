"""The registered queries against their SQL, and the pipeline against its stages."""

import os

import corpus_pipeline
import pytest
from compare import database, difference

import __spark_entry__ as entry
from tollbook.llm import queries, simhash, toxicity
from tollbook.llm.common import read_table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_its_check(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), database(FOLDER), entry.oracle_sql()[name]) is None


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline_stages_take_effect(spark):
    docs = read_table(spark, FOLDER, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    labels = read_table(spark, FOLDER, "labels")
    kept = stages["toxicity"](spark, docs, FOLDER).cache()
    bad = {r["doc_id"] for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    once = stages["simhash"](spark, kept, FOLDER).cache()
    near = simhash.near_duplicates(kept).where("doc_id = component_id")
    assert sorted(r["doc_id"] for r in once.collect()) == sorted(r["doc_id"] for r in near.collect())
    masked = stages["secrets"](spark, once, FOLDER).cache()
    assert masked.count() == once.count() and masked.where("text like '%token = %'").count() == 0
    mixed = stages["mixing"](spark, masked, FOLDER).cache()
    assert 0 < mixed.count() < masked.count() and mixed.join(masked, docs.columns, "left_anti").count() == 0
    assert all(f.columns == docs.columns for f in (kept, once, masked, mixed))
    packed = stages["packing"](spark, mixed, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}
