"""Logical warehouse tables as views over the driver's test tables.

The test bed ships TPC-H-like tables plus an ``events`` log, not the
scheduling warehouse.  This module derives the four logical tables from them
(mapping fixed in FIXTURES.md §4) with plain column expressions, so every
report still scans, prunes and pushes filters into the Parquet files and its
work grows with the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as m
from .tables import read_table

# --- fixed values of the test mapping (FIXTURES.md §4) -----------------------
SEASON_CUTOFF = "2024-01-16 00:00:00"  # events before it are season 1, else 2
EVENT_TYPE_TO_OPERATION = {
    "view": m.INVITE,
    "signup": m.SIGNUP_INTERVIEW,
    "click": m.SIGNUP_WAITLIST,
    "purchase": m.WITHDRAW,
    "error": m.CANCEL_INTERVIEW,
}
SEGMENT_TO_STATUS = {
    "AUTOMOBILE": m.STATUS_COMPLETED,
    "BUILDING": m.STATUS_MISSED_CAN_RESCHEDULE,
    "FURNITURE": m.STATUS_MISSED_CANNOT_RESCHEDULE,
    "HOUSEHOLD": m.STATUS_WITHDRAWN,
    "MACHINERY": m.STATUS_OTHER,
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, table_path(sf_dir, name))


def _case(col: str, mapping: dict, cast: str):
    expr = None
    for key, value in mapping.items():
        expr = (F.when if expr is None else expr.when)(F.col(col) == F.lit(key), F.lit(value))
    return expr.cast(cast)


def audit_dim(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """audit_dim from ``events`` (or from some of its rows): one row per user operation."""
    ev = raw(spark, sf_dir, "events") if events is None else events
    eid = F.col("event_id")
    cutoff = F.lit(SEASON_CUTOFF).cast("timestamp_ntz")
    return ev.select(
        (eid % 10).cast("bigint").alias(m.PROGRAM_ID),
        F.when(eid % 17 == 0, F.lit(None)).otherwise(F.col("user_id")).cast("bigint").alias(m.CREATED_BY_USER_ID),
        F.when(F.col("ts") < cutoff, F.lit(1)).otherwise(F.lit(2)).cast("bigint").alias(m.CALENDAR_SEASON_ID),
        _case("event_type", EVENT_TYPE_TO_OPERATION, "int").alias(m.AUDIT_OPERATION_ID),
        F.when(eid % 13 == 0, F.lit(None)).otherwise(F.expr("(event_id div 10) % 4")).cast("bigint").alias(m.INTERVIEW_EVENT_ID),
        F.col("ts").cast("timestamp_ntz").alias(m.CREATED_DATE),
        F.col("user_id").cast("bigint").alias(m.USER_ID),
        F.when(eid % 11 == 0, F.lit(None)).otherwise(F.col("user_id") * 10 + eid % 10).cast("bigint").alias(m.APPLICATION_ID),
    )


def track_tier_slot_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track_tier_slot_dim from ``supplier``: many slot rows per program."""
    s = raw(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    return s.select(
        (key % 12).cast("bigint").alias(m.PROGRAM_ID),
        (F.lit(1) + F.col("s_nationkey") % 2).cast("bigint").alias(m.CALENDAR_SEASON_ID),
        F.when(key % 12 == 3, F.lit(0)).otherwise(key % 40).cast("bigint").alias(m.ALL_TIER_QUANTITY),
    )


def application_state_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """application_state_dim from ``customer``."""
    c = raw(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("bigint").alias(m.APPLICATION_ID),
        _case("c_mktsegment", SEGMENT_TO_STATUS, "int").alias(m.INTERVIEW_STATUS_ID),
    )


def interview_event_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interview_event_dim from ``orders``: one interview day per event."""
    o = raw(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("bigint").alias(m.INTERVIEW_EVENT_ID),
        (F.lit(1) + F.col("o_custkey") % 2).cast("bigint").alias(m.CALENDAR_SEASON_ID),
        F.col("o_orderdate").cast("date").alias(m.DATE),
    )


def program_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """program_fact from ``nation``."""
    n = raw(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias(m.PROGRAM_ID),
        F.col("n_regionkey").cast("bigint").alias(m.SPECIALTY_ID),
    )
