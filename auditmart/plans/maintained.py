"""R1 and R4 maintained load by load instead of recomputed from the whole log.

Both reports roll up one table: counts per (program, season, day)
(:func:`auditmart.plans.program_audit.daily_measures`).  Those counts are sums, so the
counts of a load's new rows are a delta that adds to what is there, whatever days
they fall on; late rows need nothing special.  A load reads its own rows only, a
report reads the deltas: a few rows per group, day and load, until
:func:`compact` merges them.

Deltas are batches of a ledger (:mod:`auditmart.sources.ledger`), so a retried load
counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as m
from ..sources.ledger import committed, read_batches, write_batch
from . import daily_cancel, program_audit

DAY = [*m.GROUP_KEYS, "day"]
COUNTS = ["inv", "wd", "cn", "cancel_actors", "cancel_rows"]


def maintain(rows: DataFrame, state: str, load_id: str) -> bool:
    """Add the new audit rows of one load to the day counts under ``state``.  False if
    the load is counted already."""
    return write_batch(program_audit.daily_measures(rows), state, load_id)


def per_day(spark: SparkSession, state: str) -> DataFrame:
    """The day counts of all loads: a sum of deltas per (program, season, day)."""
    deltas = read_batches(spark, state)
    if deltas is None:
        raise ValueError(f"no load has been counted under {state}")
    return deltas.groupBy(*DAY).agg(*(F.sum(c).alias(c) for c in COUNTS))


def compact(spark: SparkSession, state: str, target: str, load_id: str) -> None:
    """Merge the deltas of ``state`` into a single one, the first batch of ``target``; later
    loads go on there.  ``state`` is left as it is, so a failure loses nothing."""
    write_batch(per_day(spark, state), target, load_id)


def program_audit_report(spark: SparkSession, state: str, slots: DataFrame, programs: DataFrame | None = None) -> DataFrame:
    """R1 from the maintained day counts."""
    days = per_day(spark, state)
    return program_audit.report(days, slots, programs, per_day=days)


def daily_cancel_report(spark: SparkSession, state: str) -> DataFrame:
    """R4 from the maintained day counts."""
    return daily_cancel.report_from_daily(per_day(spark, state))


def loads(spark: SparkSession, state: str) -> list[str]:
    """Ids of the loads counted so far."""
    return committed(spark, state)
