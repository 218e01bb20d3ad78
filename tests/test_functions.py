import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollbook.functions import dates, text

D = dt.date(2024, 1, 15)


def values(spark, inputs, expression):
    """Results of an expression over texts, in the order of the texts."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, c string").select("i", expression.alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_null_tokens_and_blanks_are_removed_but_tabs_stay(spark):
    inputs = ["null", "None", "N/A", " na ", "", "  ", None, "\tnull", " a b "]
    assert values(spark, inputs, text.clean_text("c")) == [None] * 7 + ["\tnull", "a b"]


def test_plain_and_lenient_numbers(spark):
    inputs = [" 12 ", "+3.", "-.5", "1e5", "1d", "\t4", "abc", "null", "", None, "NaN"]
    assert values(spark, inputs, text.plain_double("c")) == [12.0, 3.0, -0.5] + [None] * 8
    lenient = values(spark, inputs[:-1], text.lenient_double("c"))
    assert lenient == [12.0, 3.0, -0.5, 100000.0, 1.0, 4.0, None, None, None, None]


def test_usage_code(spark):
    assert values(spark, [" voice ", "", "  ", None, "SMS"], text.usage_code("c")) == [
        "VOICE", "UNKNOWN", "UNKNOWN", "UNKNOWN", "SMS"
    ]


def test_object_store_path(spark):
    inputs = ["s3://b/x", "s3a://b/x", "/s3://x", "S3://b"]
    assert values(spark, inputs, text.object_store_path("c")) == ["s3a://b/x", "s3a://b/x", "/s3://x", "S3://b"]


FORMS = {
    "2024-01-15": D, "20240115": D, "2024-01-15 10:11:12": D, "20240115101112": D, "15/01/2024 10:11:12": D,
    "Mon Jan 15 10:11:12 2024": D, " Mon  Jan 15 10:11:12 2024": D, "mon jan 15 10:11:12 2024": D,
}
NOT_DATES = [
    "Fri Jan  5 10:11:12 2024", "Jan 15 10:11:12 2024", "2024-1-5", "2024-02-30", "junk", "", None, "2024-01-15\n",
    " 2024-01-15", "2024-01-15T10:11:12", "2024-01-15 24:00:00", "202401151011", "15/1/2024 10:11:12", "12024-01-15",
]


def test_flexi_dates(spark):
    assert values(spark, list(FORMS), dates.flexi_date("c")) == list(FORMS.values())
    assert values(spark, NOT_DATES, dates.flexi_date("c")) == [None] * len(NOT_DATES)


def test_sorting_forms_by_separators_changes_no_result(spark):
    inputs = [*FORMS, *NOT_DATES, "-2024-01-15", "-20240115", "+12024-01-15", "0000-01-01", "15/01/-2024 10:11:12", "/:-"]
    plain = F.coalesce(*[F.try_to_date("c", form) for form in dates.FLEXI_DATE_FORMS]).cast("string")
    sorted_out = dates.first_date("c", dates.FLEXI_DATE_FORMS).cast("string")
    assert values(spark, inputs, sorted_out) == values(spark, inputs, plain)


def test_icc_dates(spark):
    inputs = ["15/01/2024 10:11:12", "2024-01-15", "20240115", "2024-01-15 10:11:12", "15/01/2024"]
    assert values(spark, inputs, dates.icc_date("c")) == [D, D, D, None, None]


def test_date_key_and_back(spark):
    df = spark.createDataFrame([(D,), (None,)], "d date").select(dates.date_key("d").alias("k"))
    assert [r["k"] for r in df.collect()] == [20240115, None]
    assert df.select(dates.date_of_key("k").alias("d")).first()["d"] == D


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((2024,), (dt.date(2024, 1, 1), dt.date(2024, 12, 31))),
        ((2024, 2), (dt.date(2024, 2, 1), dt.date(2024, 2, 29))),
        ((2023, 2, 28), (dt.date(2023, 2, 28), dt.date(2023, 2, 28))),
    ],
)
def test_year_month_day_range(spark, parts, expected):
    assert dates.year_month_day_range(*parts) == expected
    columns = [F.lit(p) for p in parts]
    row = spark.range(1).select(dates.range_start(*columns).alias("a"), dates.range_end(*columns).alias("b")).first()
    assert (row["a"], row["b"]) == expected


@pytest.mark.parametrize("parts", [(None, 1, None), (2024, None, 3), (None, None, 3), (2023, 2, 29)])
def test_impossible_parts_are_rejected(parts):
    with pytest.raises(ValueError):
        dates.check_year_month_day(*parts)
