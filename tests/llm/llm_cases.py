"""Small tables with the awkward rows that every operator must take, shared by the tests."""

from pyspark.sql import functions as F

LONG = "word " * 60_000 + "end"
CLASHES = ["score", "fp", "component_id", "spans", "tokens", "epochs", "length", "node", "root", "version", "_near_0", "rank"]


def documents(spark, rows):
    """``rows`` of (doc_id, text, lang, source); extra columns carry names that operators use inside."""
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    return frame.withColumns({name: F.lit("other") for name in CLASHES})


AWKWARD = [
    (1, "one two three four five six", "en", "a"),
    (1, "one two three four five six", "en", "a"),
    (2, "", "de", None),
    (3, None, None, "b"),
    (None, "seven eight nine ten", "en", "a"),
    (None, None, None, None),
    (4, LONG, "en", "c"),
    (5, " \t\n ", "fr", ""),
    (6, "é\U0001f600 ünï <|endoftext|> \u0130 x", "es", "b"),
]


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)
