"""Date and category dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions.dates import date_key
from tollbook.operators.numbering import next_after, number_rows


def dim_date(dated: DataFrame) -> DataFrame:
    """One row with calendar attributes per distinct ``usage_date``."""
    days = dated.select(F.col("usage_date").alias("full_date")).dropna().distinct()
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth("full_date").cast("smallint").alias("day_of_month"),
        F.month("full_date").cast("smallint").alias("month_of_year"),
        F.quarter("full_date").cast("smallint").alias("quarter_of_year"),
        F.year("full_date").alias("year_number"),
        F.weekofyear("full_date").cast("smallint").alias("week_of_year"),
        F.date_format("full_date", "E").alias("day_name"),
        F.date_format("full_date", "MMM").alias("month_name"),
        (F.weekday("full_date") >= 5).alias("is_weekend"),
    )


def dim_call_type(coded: DataFrame) -> DataFrame:
    """One active member per distinct ``call_type_code``, without its key."""
    codes = coded.select("call_type_code").dropna().distinct()
    return codes.select("call_type_code", F.col("call_type_code").alias("call_type_name"), F.lit(True).alias("is_active"))


def new_members(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Candidates whose ``key`` the dimension does not hold yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def assign_call_type_keys(members: DataFrame, existing: DataFrame) -> DataFrame:
    """Give new members the surrogate keys after the largest existing one."""
    keyed = number_rows(members, "call_type_code", "call_type_key", next_after(existing, "call_type_key"))
    return keyed.select("call_type_key", "call_type_code", "call_type_name", "is_active")


def unique_keys(dim: DataFrame) -> DataFrame:
    """Code to key lookup with one row per code, the smallest key where a code is doubled."""
    return dim.groupBy("call_type_code").agg(F.min("call_type_key").alias("call_type_key"))


def lookup_codes(dim: DataFrame, codes: DataFrame) -> DataFrame:
    """Lookup rows of the codes listed in ``codes``."""
    return unique_keys(dim.join(codes.select("call_type_code"), "call_type_code", "left_semi"))
