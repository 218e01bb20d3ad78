"""Cleaning, dates, staging and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tollbook.catalog import inputs as I
from tollbook.catalog import CHECKS, query, table
from tollbook.functions import dates, text
from tollbook.operators import clean, dimensions, shape, staging, usage
from tollbook.schemas import FLEXI_COLUMNS, FLEXI_KEYS, ICC_COLUMNS, ICC_KEYS, ICC_SCHEMA, KEYS_ICC, PROCESSED_FLEXI
from tollbook.session import scratch_path
from tollbook.sinks.keys import KeyIndex
from tollbook.sinks.store import TableStore


@query(
    "project_to_schema",
    f"with {I.RAW_ICC} select org_call_id, cast(null as varchar) as call_reference, call_sta_time, call_type, "
    "try_cast(trim(used_duration) as double) as used_duration from raw_icc",
)
def project_to_schema(spark, folder):
    return shape.fit_to_schema(I.raw_icc(spark, folder).drop("call_reference").withColumn("extra", F.lit(1)), ICC_SCHEMA)


@query(
    "select_present",
    f"with {I.RAW_FLEXI} select charging_id, record_type, duration, ftp_filename as _source_file from raw_flexi",
)
def select_present(spark, folder):
    raw = I.raw_flexi(spark, folder).withColumnRenamed("ftp_filename", "_source_file")
    return shape.select_present(raw, ["charging_id", "no_such_column", "record_type", "duration"])


@query(
    "normalize_strings",
    f"with {I.RAW_FLEXI} select {I.clean_sql('charging_id')} as charging_id, record_sequence_number, "
    f"{I.clean_sql('record_type')} as record_type, {I.clean_sql('duration')} as duration, ftp_filename from raw_flexi",
)
def normalize_strings(spark, folder):
    raw = I.raw_flexi(spark, folder).select("charging_id", "record_sequence_number", "record_type", "duration", "ftp_filename")
    return clean.normalize_strings(raw, ["charging_id", "record_type", "duration"])


@query(
    "parse_nullable_double",
    f"with {I.RAW_FLEXI} select charging_id, duration, {I.number_sql('duration')} as used_duration from raw_flexi",
)
def parse_nullable_double(spark, folder):
    raw = I.raw_flexi(spark, folder)
    return raw.select("charging_id", "duration", text.plain_double("duration").alias("used_duration"))


@query(
    "icc_duration_cast",
    f"with {I.RAW_ICC} select call_reference, try_cast(trim(used_duration) as double) as used_duration from raw_icc",
)
def icc_duration_cast(spark, folder):
    return I.raw_icc(spark, folder).select("call_reference", text.lenient_double("used_duration").alias("used_duration"))


@query(
    "drop_all_null",
    f"with {I.RAW_FLEXI} select {I.clean_sql('record_type')} as record_type, {I.clean_sql('duration')} as duration, "
    f"ftp_filename as _source_file from raw_flexi where {I.clean_sql('record_type')} is not null "
    f"or {I.clean_sql('duration')} is not null",
)
def drop_all_null(spark, folder):
    raw = I.raw_flexi(spark, folder).select("record_type", "duration", F.col("ftp_filename").alias("_source_file"))
    return clean.drop_all_null(clean.normalize_strings(raw, ["record_type", "duration"]))


@query(
    "dedup_keyed",
    "select event_id, user_id, event_type, value from events "
    "qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1",
)
def dedup_keyed(spark, folder):
    events = table(spark, folder, "events")
    first = clean.dedup_by_keys(events, ["user_id", "event_type"], [F.col("ts").asc(), F.col("event_id").asc()])
    return first.select("event_id", "user_id", "event_type", "value")


@query(
    "dedup_all_columns",
    f"with {I.RAW_FLEXI} select distinct record_sequence_number, record_type from raw_flexi",
)
def dedup_all_columns(spark, folder):
    raw = I.raw_flexi(spark, folder).select("record_sequence_number", "record_type")
    return clean.deduplicate(raw, ["no_such_key"])


@query(
    "dedup_against_staged",
    f"with {I.CLEAN_FLEXI} select charging_id, record_sequence_number, record_opening_time, record_type from clean_flexi n "
    "where not exists (select 1 from clean_flexi o where o.record_type is null "
    "and o.charging_id is not distinct from n.charging_id "
    "and o.record_sequence_number is not distinct from n.record_sequence_number "
    "and o.record_opening_time is not distinct from n.record_opening_time)",
)
def dedup_against_staged(spark, folder):
    records = clean.clean_records(I.raw_flexi(spark, folder), FLEXI_COLUMNS, FLEXI_KEYS)
    staged = records.where("record_type is null")
    return clean.drop_known(records, staged, FLEXI_KEYS).select(*FLEXI_KEYS, "record_type")


@query("dedup_by_known_keys", CHECKS["dedup_against_staged"])
def dedup_by_known_keys(spark, folder):
    """The same by a table of the known keys, stored in two batches and merged."""
    records = clean.clean_records(I.raw_flexi(spark, folder), FLEXI_COLUMNS, FLEXI_KEYS)
    keys = KeyIndex(TableStore(spark, scratch_path(spark, "store")), KEYS_ICC)
    staged = records.where("record_type is null")
    for batch_id, part in (("b1", staged.where("duration is null")), ("b2", staged)):
        keys.put_batch(part, FLEXI_KEYS, batch_id)
    keys.merge()
    return keys.new_records(records, FLEXI_KEYS, "b3").select(*FLEXI_KEYS, "record_type")


@query(
    "parse_usage_date_flexi",
    f"with {I.RAW_FLEXI} select record_opening_time, {I.date_sql('record_opening_time', I.FLEXI_FORMS)} as usage_date "
    "from raw_flexi",
)
def parse_usage_date_flexi(spark, folder):
    raw = I.raw_flexi(spark, folder)
    return raw.select("record_opening_time", dates.flexi_date("record_opening_time").alias("usage_date"))


@query(
    "parse_usage_date_icc",
    f"with {I.RAW_ICC} select call_reference, call_sta_time, {I.date_sql('call_sta_time', I.ICC_FORMS)} as usage_date "
    "from raw_icc",
)
def parse_usage_date_icc(spark, folder):
    raw = I.raw_icc(spark, folder)
    return raw.select("call_reference", "call_sta_time", dates.icc_date("call_sta_time").alias("usage_date"))


@query(
    "call_type_code",
    f"with {I.RAW_FLEXI} select record_type, {I.code_sql('record_type')} as call_type_code from raw_flexi",
)
def call_type_code(spark, folder):
    return I.raw_flexi(spark, folder).select("record_type", text.usage_code("record_type").alias("call_type_code"))


@query("clean_flexi", f"with {I.CLEAN_FLEXI} select * from clean_flexi")
def clean_flexi(spark, folder):
    return clean.clean_records(I.raw_flexi(spark, folder), FLEXI_COLUMNS, FLEXI_KEYS)


@query("clean_icc", f"with {I.CLEAN_ICC} select * from clean_icc")
def clean_icc(spark, folder):
    return clean.clean_records(shape.fit_to_schema(I.raw_icc(spark, folder), ICC_SCHEMA), ICC_COLUMNS, ICC_KEYS)


@query("staging_flexi", f"with {I.STAGING_FLEXI} select * from staging_flexi")
def staging_flexi(spark, folder):
    return staging.stage_flexi(clean_flexi(spark, folder))


@query("staging_icc", f"with {I.STAGING_ICC} select * from staging_icc")
def staging_icc(spark, folder):
    return staging.stage_icc(clean_icc(spark, folder))


def staged_through_table(spark, folder):
    """Staging rows from the processed table, as a batch makes them."""
    store = TableStore(spark, scratch_path(spark, "processed"))
    raw = I.raw_flexi(spark, folder).withColumns(
        {"_source_file": F.col("ftp_filename"), "_ingested_at": F.current_timestamp()}
    )
    store.write_batch(clean.clean_records(raw, FLEXI_COLUMNS, FLEXI_KEYS), PROCESSED_FLEXI, "b1")
    return staging.stage_flexi(store.read_batch(PROCESSED_FLEXI, "b1"))


@query("usage_prepared", f"with {I.PREPARED_FLEXI} select usage_date, call_type_code, used_duration from prepared")
def usage_prepared(spark, folder):
    return usage.prepare_usage(staged_through_table(spark, folder)).drop("record_id")


@query(
    "string_functions",
    f"with {I.RAW_FLEXI} select record_type, duration, {I.clean_sql('record_type')} as cleaned, "
    f"{I.code_sql('record_type')} as code, {I.number_sql('duration')} as number from raw_flexi",
)
def string_functions(spark, folder):
    return I.raw_flexi(spark, folder).select(
        "record_type", "duration", text.clean_text("record_type").alias("cleaned"),
        text.usage_code("record_type").alias("code"), text.plain_double("duration").alias("number"),
    )


@query(
    "date_functions",
    "with days as (select distinct cast(o_orderdate as date) as d from orders) "
    "select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date, cast(day(d) as smallint) as day_of_month, "
    "cast(quarter(d) as smallint) as quarter_of_year, cast(weekofyear(d) as smallint) as week_of_year, "
    "strftime(d, '%a') as day_name, strftime(d, '%b') as month_name, dayofweek(d) in (0, 6) as is_weekend, "
    "cast(date_trunc('month', d) as date) as month_from, last_day(d) as month_to from days",
)
def date_functions(spark, folder):
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("usage_date"))
    year, month = F.col("year_number"), F.col("month_of_year")
    return dimensions.dim_date(days).select(
        "date_key", "full_date", "day_of_month", "quarter_of_year", "week_of_year", "day_name", "month_name", "is_weekend",
        dates.range_start(year, month).alias("month_from"), dates.range_end(year, month).alias("month_to"),
    )


@query(
    "conditional_functions",
    f"with {I.RAW_FLEXI}, cleaned as (select duration, {I.clean_sql('record_type')} as kind, {I.clean_sql('charging_id')} as id "
    f"from raw_flexi) select kind, id, {I.code_sql('kind')} as code, try_cast(trim(duration) as double) as amount from cleaned",
)
def conditional_functions(spark, folder):
    cleaned = clean.normalize_strings(I.raw_flexi(spark, folder), ["record_type", "charging_id"])
    return cleaned.select(
        F.col("record_type").alias("kind"), F.col("charging_id").alias("id"),
        text.usage_code("record_type").alias("code"), text.lenient_double("duration").alias("amount"),
    )


@query(
    "ymd_range",
    "select o_orderkey, make_date(year(d), 1, 1) as year_from, make_date(year(d), 12, 31) as year_to, "
    "cast(date_trunc('month', d) as date) as month_from, last_day(d) as month_to, d as day_from, d as day_to "
    "from (select o_orderkey, cast(o_orderdate as date) as d from orders)",
)
def ymd_range(spark, folder):
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.range_start(y).alias("year_from"),
        dates.range_end(y).alias("year_to"),
        dates.range_start(y, m).alias("month_from"),
        dates.range_end(y, m).alias("month_to"),
        dates.range_start(y, m, d).alias("day_from"),
        dates.range_end(y, m, d).alias("day_to"),
    )
