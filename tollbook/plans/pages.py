"""Pages of the stored staging rows: the next one by a token, the total with it, and only the folders that hold it."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook import schemas as S
from tollbook.functions.dates import check_year_month_day
from tollbook.operators import serving
from tollbook.operators.paging import SHALLOW_ROWS, page
from tollbook.session import written_once
from tollbook.sinks.store import TableStore

TIME = "_ingested_at"
#: Days of ingest are those of UTC, whatever the session's time zone; in microseconds.
EPOCH, DAY = date(1970, 1, 1), 86_400_000_000


@dataclass(frozen=True)
class Kind:
    """A staging table with the counts kept beside it, the columns its pages show, and those that settle equal times."""

    staging: S.Table
    days: S.Table
    shown: list[str]
    ties: list[str]


FLEXI = Kind(S.STAGING_FLEXI, S.DAYS_FLEXI, serving.STAGING_FLEXI_COLUMNS, [*S.FLEXI_KEYS, "_source_file"])
ICC = Kind(S.STAGING_ICC, S.DAYS_ICC, serving.STAGING_ICC_COLUMNS, [*S.ICC_KEYS, "_source_file"])


@dataclass(frozen=True)
class Page:
    """Rows of a page, the token of the next one (None after the last), and all rows the filters leave, if asked for."""

    rows: DataFrame
    token: str | None
    total: int | None = None


def _after(ties: list[str], key: list) -> Column:
    """Rows that come after a key, last ingested first and then by the ties."""
    micros, *values = key
    time = F.col(TIME)
    same = time.isNull() if micros is None else time == F.timestamp_micros(F.lit(micros))
    found = time.isNotNull() if micros is None else time < F.timestamp_micros(F.lit(micros))
    for name, value in zip(ties, values):
        column = F.col(name)
        if value is None:  # nulls are last
            same = same & column.isNull()
            continue
        found = found | (same & ((column > value) | column.isNull()))
        same = same & (column == value)
    return found


def staging_page(
    store: TableStore, kind: Kind, limit: int = 50, token: str | None = None, year: int | None = None, month: int | None = None,
    day: int | None = None, include_total: bool = False,
) -> Page:
    """The page after the one that ``token`` came with, last ingested first; without a token the first page.

    The counts kept by the writer say which days of ingest hold the page and in which folders their rows are; other rows
    are neither read nor listed, and the total needs no rows at all. A page stays where it is when newer rows arrive.
    """
    serving._check_page(limit, 0, serving.MAX_STAGING_PAGE)
    check_year_month_day(year, month, day)
    wanted = {n: v for n, v in (("year", year), ("month", month), ("day", day)) if year and v}
    counts = store.read(kind.days)
    for name, value in wanted.items():
        counts = counts.where(F.col(name) == value)
    total = counts.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0] if include_total else None
    key = json.loads(token) if token else None
    folders, inside = _folders(counts, limit, key)
    if not folders:
        return Page(store.read(kind.staging, {"batch_id": []}).select(*kind.shown), None, total)
    rows = serving.filter_staging(store.read(kind.staging, folders), year, month, day).where(inside)
    if key:
        rows = rows.where(_after(kind.ties, key))
    order = [F.col(TIME).desc_nulls_first(), *[F.col(name).asc_nulls_last() for name in kind.ties]]
    # The sort key travels beside the row: the page need not show all of it.
    sort_key = F.to_json(F.array(F.unix_micros(TIME).cast("string"), *[F.col(name).cast("string") for name in kind.ties]))
    found = page(rows.select(*kind.shown, sort_key.alias("_key"), *[n for n in kind.ties if n not in kind.shown]), order, limit)
    if limit <= SHALLOW_ROWS:
        held = found.collect()  # at most SHALLOW_ROWS rows
        shown = store.spark.createDataFrame(held, found.schema).select(*kind.shown)
        last = held[-1]["_key"] if len(held) == limit else None
    else:
        written = written_once(found, "page")
        end = [F.col(TIME).asc_nulls_last(), *[F.col(name).desc_nulls_first() for name in kind.ties]]
        last = written.orderBy(*end).select("_key").first()["_key"] if written.count() == limit else None
        shown = written.orderBy(*order).select(*kind.shown)
    return Page(shown, _token(last), total)


def _token(sort_key: str | None) -> str | None:
    if sort_key is None:
        return None
    micros, *values = json.loads(sort_key)
    return json.dumps([None if micros is None else int(micros), *values])


def _folders(counts: DataFrame, limit: int, key: list | None) -> tuple[dict[str, set], Column]:
    """Folders by the values of their columns, and the days of ingest, that hold the next ``limit`` rows after a key."""
    days = counts.groupBy("ingested_day").agg(F.sum("row_count").alias("rows"))
    open_ = F.lit(True)
    if key and key[0] is not None:
        # The day of the key itself may be used up already, so its rows count for nothing.
        edge = F.lit(EPOCH + timedelta(days=key[0] // DAY))
        open_ = F.col("ingested_day") <= edge
        days = days.where(open_).withColumn("rows", F.when(F.col("ingested_day") == edge, 0).otherwise(F.col("rows")))
    elif key:
        days = days.withColumn("rows", F.when(F.col("ingested_day").isNull(), 0).otherwise(F.col("rows")))
    before = F.sum("rows").over(Window.orderBy(F.col("ingested_day").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    needed = days.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < limit)  # one row a day
    chosen = needed.select(F.col("ingested_day").alias("_day"))
    met = counts.where(open_).join(chosen, F.col("ingested_day").eqNullSafe(F.col("_day")), "left_semi")
    found = met.agg(
        *[F.collect_set(F.struct(name)).alias(name) for name in ("year", "month", "batch_id")],
        F.min("ingested_day").alias("oldest"), F.max("ingested_day").alias("newest"), F.bool_or(F.col("ingested_day").isNull()).alias("undated"),
    ).first()
    if not found["batch_id"]:
        return {}, F.lit(False)
    inside = F.lit(False)
    if found["oldest"] is not None:
        begin, end = ((day - EPOCH).days * DAY for day in (found["oldest"], found["newest"] + timedelta(days=1)))
        inside = (F.col(TIME) >= F.timestamp_micros(F.lit(begin))) & (F.col(TIME) < F.timestamp_micros(F.lit(end)))
    if found["undated"]:
        inside = inside | F.col(TIME).isNull()
    return {name: {r[0] for r in found[name]} for name in ("year", "month", "batch_id")}, inside
