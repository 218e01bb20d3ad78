"""Raw usage records shaped from the test tables, once for Spark and once as SQL.

The test tables are clean, so null tokens, odd numbers and several date forms are
made here. Expression texts below are valid in both engines; only date formatting
differs. Every event occurs twice, in two files, so that de-duplication has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.catalog import table
from tollbook.schemas import FLEXI_COLUMNS, ICC_COLUMNS

DIRTY_TYPE = (
    "case event_id % 6 when 0 then ' NULL ' when 1 then 'n/a' when 2 then '' "
    "when 3 then cast(null as {text}) else concat('  ', event_type, ' ') end"
)
DIRTY_NUMBER = (
    "case event_id % 7 when 0 then ' 12 ' when 1 then '1e5' when 2 then '+3.' when 3 then '-.5' "
    "when 4 then 'abc' when 5 then 'NA' else cast(cast(value as decimal(18,2)) as {text}) end"
)
DIRTY_ID = "case event_id % 11 when 0 then ' null ' else cast(event_id as {text}) end"
ICC_NUMBER = (
    "case o_orderkey % 5 when 0 then ' 12 ' when 1 then '1e5' when 2 then 'abc' when 3 then '' "
    "else cast(cast(o_totalprice as decimal(18,2)) as {text}) end"
)

SPARK_FORMS = {
    "iso": "yyyy-MM-dd", "compact": "yyyyMMdd", "iso_time": "yyyy-MM-dd HH:mm:ss", "compact_time": "yyyyMMddHHmmss",
    "slash_time": "dd/MM/yyyy HH:mm:ss", "weekday": "EEE MMM dd HH:mm:ss yyyy",
}
DUCKDB_FORMS = {
    "iso": "%Y-%m-%d", "compact": "%Y%m%d", "iso_time": "%Y-%m-%d %H:%M:%S", "compact_time": "%Y%m%d%H%M%S",
    "slash_time": "%d/%m/%Y %H:%M:%S", "weekday": "%a %b %d %H:%M:%S %Y",
}


def _dirty_time(key: str, time: str, forms: list[str], formatter: str, patterns: dict[str, str]) -> str:
    cases = " ".join(
        f"when {i} then {formatter}({time}, '{patterns[form]}')" for i, form in enumerate(forms)
    )
    return f"case {key} % {len(forms) + 1} {cases} else 'junk' end"


FLEXI_FORMS = ["iso", "compact", "iso_time", "compact_time", "slash_time", "weekday"]
ICC_FORMS = ["slash_time", "iso", "compact"]


def _flexi_expressions(text: str, time: str) -> dict[str, str]:
    return {
        "charging_id": DIRTY_ID.format(text=text),
        "record_sequence_number": f"concat(' ', cast(user_id as {text}), ' ')",
        "record_opening_time": time,
        "record_type": DIRTY_TYPE.format(text=text),
        "duration": DIRTY_NUMBER.format(text=text),
        "served_msisdn": f"cast(user_id as {text})",
    }


def _icc_expressions(text: str, time: str) -> dict[str, str]:
    return {
        "org_call_id": f"case o_orderkey % 9 when 0 then 'None' else cast(o_orderkey as {text}) end",
        "call_reference": f"concat(' ', cast(o_orderkey as {text}))",
        "call_sta_time": time,
        "call_type": "concat(o_orderpriority, ' ')",
        "used_duration": ICC_NUMBER.format(text=text),
    }


def raw_flexi(spark: SparkSession, folder: str) -> DataFrame:
    """Flexi records, each event in files f1.csv and f2.csv."""
    time = _dirty_time("event_id", "ts", FLEXI_FORMS, "date_format", SPARK_FORMS)
    columns = [F.expr(e).alias(n) for n, e in _flexi_expressions("string", time).items()]
    files = F.explode(F.array(F.lit("f1.csv"), F.lit("f2.csv"))).alias("ftp_filename")
    return table(spark, folder, "events").select(*columns, files)


def raw_icc(spark: SparkSession, folder: str) -> DataFrame:
    """Icc records, all text, each order once."""
    time = _dirty_time("o_orderkey", "o_orderdate", ICC_FORMS, "date_format", SPARK_FORMS)
    columns = [F.expr(e).alias(n) for n, e in _icc_expressions("string", time).items()]
    return table(spark, folder, "orders").select(*columns)


def _select_list(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in expressions.items())


_FLEXI_SQL = _select_list(
    _flexi_expressions("varchar", _dirty_time("event_id", "ts", FLEXI_FORMS, "strftime", DUCKDB_FORMS))
)
_ICC_SQL = _select_list(
    _icc_expressions("varchar", _dirty_time("o_orderkey", "o_orderdate", ICC_FORMS, "strftime", DUCKDB_FORMS))
)


def clean_sql(c: str) -> str:
    return f"case when trim({c}) = '' or lower(trim({c})) in ('null', 'none', 'n/a', 'na') then null else trim({c}) end"


def number_sql(c: str) -> str:
    form = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
    return f"case when regexp_matches(trim({c}), '{form}') then try_cast(trim({c}) as double) end"


def code_sql(c: str) -> str:
    return f"case when {c} is null or trim({c}) = '' then 'UNKNOWN' else upper(trim({c})) end"


def date_sql(c: str, forms: list[str]) -> str:
    tries = []
    for form in forms:
        text = f"regexp_replace(trim({c}), '^[A-Za-z]{{3}}\\s+', '')" if form == "weekday" else c
        pattern = DUCKDB_FORMS[form].removeprefix("%a ")
        tries.append(f"try_strptime({text}, '{pattern}')")
    return f"cast(coalesce({', '.join(tries)}) as date)"


def _parts_sql(date: str) -> str:
    return ", ".join(f"cast({part}({date}) as integer) as {part}" for part in ("year", "month", "day"))


def clean_cte(source: str, columns: list[str], keys: list[str], texts: list[str] | None = None, first: str | None = None) -> str:
    texts = columns if texts is None else texts
    normalized = ", ".join(f"{clean_sql(c)} as {c}" if c in texts else c for c in columns) + (f", {first}" if first else "")
    order = ", ".join([first] if first else []) + (", " if first else "")
    order += ", ".join(f"{c} nulls first" for c in columns if c not in keys)
    some = " or ".join(f"{c} is not null" for c in columns)
    return (
        f"select {', '.join(columns)} from (select {normalized} from {source}) where {some} "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {order}) = 1"
    )


RAW_FLEXI = (
    f"raw_flexi as (select {_FLEXI_SQL}, unnest(['f1.csv', 'f2.csv']) as ftp_filename from events)"
)
CLEAN_FLEXI = RAW_FLEXI + ", clean_flexi as (" + clean_cte(
    "raw_flexi", FLEXI_COLUMNS, ["charging_id", "record_sequence_number", "record_opening_time"]
) + ")"
STAGING_FLEXI = CLEAN_FLEXI + (
    f", staging_flexi as (select * exclude (usage_date), {_parts_sql('usage_date')} from "
    f"(select *, {date_sql('record_opening_time', FLEXI_FORMS)} as usage_date from clean_flexi))"
)
PREPARED_FLEXI = STAGING_FLEXI + (
    ", prepared as (select make_date(year, month, day) as usage_date, "
    f"{code_sql('record_type')} as call_type_code, {number_sql('duration')} as used_duration "
    "from staging_flexi where year is not null)"
)
DAILY_FLEXI = PREPARED_FLEXI + (
    ", daily as (select usage_date, call_type_code, count(*) as event_count, sum(used_duration) as total_used_duration "
    "from prepared group by usage_date, call_type_code)"
)
RAW_ICC = f"raw_icc as (select {_ICC_SQL} from orders)"
TYPED_ICC = RAW_ICC + (
    ", typed_icc as (select * replace (try_cast(trim(used_duration) as double) as used_duration) from raw_icc)"
)
CLEAN_ICC = TYPED_ICC + ", clean_icc as (" + clean_cte(
    "typed_icc", ICC_COLUMNS, ["org_call_id", "call_reference"], ICC_COLUMNS[:-1]
) + ")"
STAGING_ICC = CLEAN_ICC + (
    f", staging_icc as (select * exclude (usage_date), {_parts_sql('usage_date')} from "
    f"(select *, {date_sql('call_sta_time', ICC_FORMS)} as usage_date from clean_icc))"
)
