"""Compare every registered query with its SQL: python tests/compare.py [sf_dir] [name ...]"""

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return f"{type(value).__name__} {value}"


def ordered(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in places], sorted(tuple(normal(row[i]) for i in places) for row in rows)


def difference(spark_df, con, sql):
    """None if both give the same columns and rows, else a text showing the difference."""
    names, rows = ordered(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.sql(sql)
    expected_names, expected = ordered(result.columns, result.fetchall())
    if names != expected_names:
        return f"columns {names} instead of {expected_names}"
    if rows != expected:
        extra, missing = sorted(set(rows) - set(expected))[:3], sorted(set(expected) - set(rows))[:3]
        return f"{len(rows)} rows instead of {len(expected)}; extra {extra}; missing {missing}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("COMPARE_TIME_ZONE", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = database(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            found = difference(run(spark, folder), con, checks[name]) if name in checks else "no SQL"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:28} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
