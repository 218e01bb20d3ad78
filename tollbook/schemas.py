"""Columns, flags and table definitions of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, DOUBLE, BOOLEAN = T.StringType(), T.DoubleType(), T.BooleanType()
SHORT, INT, LONG = T.ShortType(), T.IntegerType(), T.LongType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
AMOUNT = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw record layouts.
FLEXI_SCHEMA = _schema(
    charging_id=STRING, record_sequence_number=STRING, record_opening_time=STRING,
    record_type=STRING, duration=STRING, served_msisdn=STRING, ftp_filename=STRING,
    )
ICC_SCHEMA = _schema(
    org_call_id=STRING, call_reference=STRING, call_sta_time=STRING, call_type=STRING,
    used_duration=DOUBLE,
    )
LINEAGE_SCHEMA = _schema(_source_file=STRING, _ingested_at=TIMESTAMP)
DATE_PARTS_SCHEMA = _schema(year=INT, month=INT, day=INT)

FLEXI_COLUMNS = FLEXI_SCHEMA.fieldNames()
ICC_COLUMNS = ICC_SCHEMA.fieldNames()
LINEAGE_COLUMNS = LINEAGE_SCHEMA.fieldNames()

# Identity of a record inside one batch.
FLEXI_KEYS = ["charging_id", "record_sequence_number", "record_opening_time"]
ICC_KEYS = ["org_call_id", "call_reference"]

# Manifest states and datasets.
PENDING, SUCCESS, FAILED, CLAIMED = 0, 1, 2, 9
FLEXI, ICC, UNKNOWN = "flexi", "icc", "unknown"
DEFAULT_JOB = "transform_usage_daily"
DEFAULT_CLAIM_SIZE = 40
ERROR_TEXT_LENGTH = 1900


@dataclass(frozen=True)
class Table:
    """A stored table: schema, layout and the rules its writer enforces.

    ``versioned`` tables change in one step, however many partitions a write touches.
    """

    name: str
    schema: T.StructType
    partitioned_by: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)
    versioned: bool = False
    #: Columns that rows are looked up by: rows are in their order inside a file, and each has a Bloom filter.
    lookups: tuple[str, ...] = ()


_BATCH = _schema(batch_id=STRING)

# The stored tables.
PROCESSED_FLEXI = Table(
    "processed/flexi",
    T.StructType(FLEXI_SCHEMA.fields + LINEAGE_SCHEMA.fields + _BATCH.fields),
    partitioned_by=("batch_id",),
)
PROCESSED_ICC = Table(
    "processed/icc",
    T.StructType(ICC_SCHEMA.fields + LINEAGE_SCHEMA.fields + _BATCH.fields),
    partitioned_by=("batch_id",),
)
STAGING_FLEXI = Table(
    "staging/flexi",
    T.StructType(FLEXI_SCHEMA.fields + LINEAGE_SCHEMA.fields + DATE_PARTS_SCHEMA.fields + _BATCH.fields),
    partitioned_by=("year", "month", "batch_id"),
    lookups=("charging_id", "served_msisdn"),
)
STAGING_ICC = Table(
    "staging/icc",
    T.StructType(ICC_SCHEMA.fields + LINEAGE_SCHEMA.fields + DATE_PARTS_SCHEMA.fields + _BATCH.fields),
    partitioned_by=("year", "month", "batch_id"),
    lookups=("org_call_id",),
)
# Rows per day of their ingest and date parts, kept by the writer of staging rows; pages are found by them.
_DAYS = _schema(ingested_day=DATE, year=INT, month=INT, day=INT, batch_id=STRING, row_count=LONG)
DAYS_FLEXI = Table("staging/flexi_days", _DAYS, versioned=True)
DAYS_ICC = Table("staging/icc_days", _DAYS, versioned=True)
DIM_DATE = Table(
    "warehouse/dim_date",
    _schema(
        date_key=INT, full_date=DATE, day_of_month=SHORT, month_of_year=SHORT,
        quarter_of_year=SHORT, year_number=INT, week_of_year=SHORT, day_name=STRING,
        month_name=STRING, is_weekend=BOOLEAN, created_at=TIMESTAMP, batch_id=STRING,
    ),
    versioned=True,
    unique=(("date_key",), ("full_date",)),
    required=(
        "date_key", "full_date", "day_of_month", "month_of_year", "quarter_of_year",
        "year_number", "week_of_year", "day_name", "month_name", "is_weekend",
    ),
    widths={"day_name": 10, "month_name": 10},
)
DIM_CALL_TYPE = Table(
    "warehouse/dim_call_type",
    _schema(
        call_type_key=LONG, call_type_code=STRING, call_type_name=STRING, is_active=BOOLEAN,
        created_at=TIMESTAMP, batch_id=STRING,
    ),
    versioned=True,
    unique=(("call_type_key",), ("call_type_code",)),
    required=("call_type_key", "call_type_code", "call_type_name", "is_active"),
    widths={"call_type_code": 50, "call_type_name": 100},
)
# The fact and the summary hold few rows per day, so their folders are months.
FACT_USAGE_DAILY = Table(
    "warehouse/fact_usage_daily",
    _schema(
        date_key=INT, call_type_key=LONG, usage_date=DATE, call_type=STRING, event_count=LONG,
        total_used_duration=AMOUNT, created_at=TIMESTAMP, usage_month=DATE, batch_id=STRING,
    ),
    partitioned_by=("usage_month",),
    required=("event_count",),
    widths={"call_type": 50},
    versioned=True,
)
CURATED_FACT = Table(
    "curated/fact_usage_daily",
    _schema(
        date_key=INT, call_type_key=LONG, usage_date=DATE, call_type_code=STRING, event_count=LONG,
        total_used_duration=DOUBLE,
    ),
    versioned=True,
)
USAGE_SUMMARY_DAILY = Table(
    "warehouse/usage_summary_daily",
    _schema(
        usage_date=DATE, call_type_key=LONG, call_type_code=STRING, event_count=LONG,
        total_used_duration=AMOUNT, created_at=TIMESTAMP, usage_month=DATE,
    ),
    partitioned_by=("usage_month",),
    unique=(("usage_date", "call_type_code"),),
    required=("usage_date", "call_type_code", "event_count"),
    widths={"call_type_code": 50},
    versioned=True,
)
# Known record keys, see ``sinks/keys.py``.
KEYS_ICC = Table("keys/icc", _schema(record_key=T.BinaryType()), versioned=True)
# ``part`` names what a row is: a change not yet folded (log), an older one (history), or the latest state of a file whose
# work may go on (open) or has ended (settled).
MANIFEST = Table(
    "manifest",
    _schema(
        id=LONG, job_name=STRING, s3_path=STRING, ingest_time=TIMESTAMP, processed_flag=SHORT,
        processed_time=TIMESTAMP, batch_id=STRING, error_message=STRING, change_no=LONG, part=STRING,
    ),
    partitioned_by=("part",),
    unique=(("job_name", "s3_path"),),
    required=("id", "job_name", "s3_path", "ingest_time", "processed_flag"),
    widths={"job_name": 100, "s3_path": 1000, "batch_id": 64, "error_message": 2000},
    versioned=True,
)
MANIFEST_COLUMNS = [name for name in MANIFEST.schema.fieldNames() if name not in ("change_no", "part")]
