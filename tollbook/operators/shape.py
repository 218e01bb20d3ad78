"""Fitting a frame to an expected set of columns."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollbook.schemas import LINEAGE_COLUMNS

logger = logging.getLogger(__name__)


def fit_to_schema(df: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Columns of ``schema`` by exact name: cast leniently, typed NULL where absent.

    Columns named in ``keep`` follow when the frame has them; all others are dropped.
    """
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        logger.warning("input lacks expected columns: %s", ", ".join(absent))
    fitted = [
        (F.lit(None).cast(f.dataType) if f.name in absent else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    return df.select(*fitted, *[name for name in keep if name in df.columns])


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Wanted columns plus lineage columns, in that order, without those the frame lacks."""
    names = dict.fromkeys([*wanted, *LINEAGE_COLUMNS])
    return df.select(*[name for name in names if name in df.columns])


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> DataFrame:
    """The frame itself, or ValueError naming the missing columns."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns in {label}: {', '.join(missing)}")
    return df


def with_lineage(df: DataFrame, source: str = "_metadata.file_path") -> DataFrame:
    """Add source file and ingest time where the frame does not carry them already."""
    lineage = {"_source_file": F.col(source), "_ingested_at": F.current_timestamp()}
    return df.withColumns({k: v for k, v in lineage.items() if k not in df.columns})


def business_columns(df: DataFrame) -> list[str]:
    """Columns that describe the record, not how it was loaded."""
    return [name for name in df.columns if not name.startswith("_")]
