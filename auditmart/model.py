"""Data model: column names, operation / status codes and table contracts.

The reporting mart works on four logical warehouse tables (audit log, slot
dimension, application state, program fact).  Every column name and code lives
here so that the operators never spell a literal twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- column names -----------------------------------------------------------
PROGRAM_ID = "program_id"
CALENDAR_SEASON_ID = "calendar_season_id"
CREATED_BY_USER_ID = "created_by_user_id"
AUDIT_OPERATION_ID = "audit_operation_id"
INTERVIEW_EVENT_ID = "interview_event_id"
DATE = "date"
CREATED_DATE = "created_date"
USER_ID = "user_id"
APPLICATION_ID = "application_id"
ALL_TIER_QUANTITY = "all_tier_quantity"
SPECIALTY_ID = "specialty_id"
INTERVIEW_STATUS_ID = "interview_status_id"

# Report grain shared by every (program, season) report.
GROUP_KEYS = [PROGRAM_ID, CALENDAR_SEASON_ID]

# --- fixed values: operation codes of the audit log --------------------------
INVITE = 1
SIGNUP_INTERVIEW = 2
SIGNUP_WAITLIST = 3
WITHDRAW = 4
CANCEL_INTERVIEW = 5

# --- fixed values: interview status codes of application state ---------------
STATUS_COMPLETED = 1
STATUS_MISSED_CAN_RESCHEDULE = 2
STATUS_MISSED_CANNOT_RESCHEDULE = 3
STATUS_WITHDRAWN = 4
STATUS_OTHER = 5

# "canceled or missed" keeps the literal code list of the source report, which
# includes "completed" (SURVEY Q2).
STATUS_CANCELED_OR_MISSED = [
    STATUS_COMPLETED,
    STATUS_MISSED_CAN_RESCHEDULE,
    STATUS_MISSED_CANNOT_RESCHEDULE,
]

# --- table contracts ---------------------------------------------------------
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField(PROGRAM_ID, T.LongType()),
        T.StructField(CREATED_BY_USER_ID, T.LongType()),
        T.StructField(CALENDAR_SEASON_ID, T.LongType()),
        T.StructField(AUDIT_OPERATION_ID, T.IntegerType()),
        T.StructField(INTERVIEW_EVENT_ID, T.LongType()),
        T.StructField(CREATED_DATE, T.TimestampNTZType()),
        T.StructField(USER_ID, T.LongType()),
        T.StructField(APPLICATION_ID, T.LongType()),
    ]
)

SLOT_SCHEMA = T.StructType(
    [
        T.StructField(PROGRAM_ID, T.LongType()),
        T.StructField(CALENDAR_SEASON_ID, T.LongType()),
        T.StructField(ALL_TIER_QUANTITY, T.LongType()),
    ]
)

APPLICATION_STATE_SCHEMA = T.StructType(
    [
        T.StructField(APPLICATION_ID, T.LongType()),
        T.StructField(INTERVIEW_STATUS_ID, T.IntegerType()),
    ]
)

PROGRAM_SCHEMA = T.StructType(
    [
        T.StructField(PROGRAM_ID, T.LongType()),
        T.StructField(SPECIALTY_ID, T.LongType()),
    ]
)

INTERVIEW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField(INTERVIEW_EVENT_ID, T.LongType()),
        T.StructField(CALENDAR_SEASON_ID, T.LongType()),
        T.StructField(DATE, T.DateType()),
    ]
)


class ContractError(ValueError):
    """A source table misses a column the contract requires."""


def src_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: select by name (case-insensitive, as
    Spark resolves) and cast to the contract type (a ``timestamp`` column stays an
    instant where the contract says ``timestamp_ntz``).  Extra columns are pruned,
    which also prunes them from the Parquet ``ReadSchema``."""
    present = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ContractError(f"missing columns {missing}; have {df.columns}")
    cols: list[Column] = []
    for f in schema.fields:
        src = df[present[f.name.lower()]]
        kind = f.dataType
        if isinstance(kind, T.TimestampNTZType) and isinstance(src_type(df, present[f.name.lower()]), T.TimestampType):
            kind = T.TimestampType()  # an instant stays one: a zone-less copy would shift in clock changes
        cols.append(src.cast(kind).alias(f.name))
    return df.select(*cols)
