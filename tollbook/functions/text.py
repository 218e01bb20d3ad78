"""String and number rules of raw usage records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value", and the accepted form of a plain number.
NULL_TOKENS = ("null", "none", "n/a", "na")
PLAIN_NUMBER = r"^[+-]?(?:\d+(?:\.\d*)?|\.\d+)$"
UNKNOWN_CODE = "UNKNOWN"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def without_null_tokens(c: Column | str) -> Column:
    """Trimmed text with NULL for blank text and null tokens."""
    text = _column(c)
    return F.when((text != "") & ~F.lower(text).isin(*NULL_TOKENS), text)


def clean_text(c: Column | str) -> Column:
    """Text without outer spaces; blank text and null tokens become NULL. Tabs are kept."""
    return without_null_tokens(F.trim(_column(c)))


def plain_double(c: Column | str) -> Column:
    """Double from plain decimal notation; exponents, NaN, suffixes and words give NULL."""
    text = F.trim(_column(c).cast("string"))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def lenient_double(c: Column | str) -> Column:
    """Double from anything Spark can cast, NULL otherwise."""
    return _column(c).try_cast("double")


def usage_code(c: Column | str) -> Column:
    """Upper-case category code; missing or blank becomes UNKNOWN."""
    return F.coalesce(F.upper(F.nullif(F.trim(_column(c)), F.lit(""))), F.lit(UNKNOWN_CODE))


def fixed_amount(c: Column | str) -> Column:
    """Amount with two decimals, rounded half up; values too wide for it raise."""
    return _column(c).cast("decimal(18,2)")


def object_store_path(c: Column | str) -> Column:
    """``s3://`` paths in the form the Hadoop connector reads; others unchanged."""
    return F.regexp_replace(_column(c), "^s3://", "s3a://")
