"""R2 over a log that is stored where its aggregation needs it.

R2 groups the whole log by (program, season, actor) and joins the result back to the
log on the same keys.  Stored in buckets of these keys and sorted inside them, the
log needs neither a shuffle nor a sort for either: every task reads one bucket and
finishes its actors.

A bucket is one task, so an actor with very many rows must not be in one.  Such actors
are found by a frequency sketch while the table is written and go, with rows that name
no actor, to a second table without buckets; its rows take the ordinary plan.  No
actor is in both tables, so the two results add up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model as m
from ..operators import audit as ops
from ..operators.frequent import heavy_items
from ..sources.tables import cluster, write_table
from . import waitlist

HOT_ROWS = 1_000_000  # rows of an actor that no single task should have to read


@dataclass(frozen=True)
class BucketedLog:
    """The catalog name of the bucketed table and the path of the other rows."""

    table: str
    rest: str


def write_log(audit: DataFrame, log: BucketedLog, path: str, num_buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Store ``audit`` (overwriting): actors of up to ``hot_rows`` rows in ``num_buckets``
    buckets at ``path``, the rows of the others and of no actor under ``log.rest``."""
    actor = m.CREATED_BY_USER_ID
    hot = heavy_items(audit, actor, {"rows": F.lit(True)}, lambda n: n["rows"] > hot_rows)
    named = audit.where(F.col(actor).isNotNull())
    keys = ops.ACTOR_KEYS
    (
        named.join(hot, actor, "left_anti")
        .select(*audit.columns)
        .repartition(num_buckets, *keys)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(num_buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(log.table)
    )
    rest = named.join(hot, actor, "left_semi").select(*audit.columns).unionByName(audit.where(F.col(actor).isNull()))
    write_table(cluster(rest, [*keys, m.CREATED_DATE]), log.rest, mode="overwrite")


def read_log(spark: SparkSession, log: BucketedLog) -> tuple[DataFrame, DataFrame]:
    """The bucketed rows and the rest."""
    return ops.audit_base(spark.table(log.table)), ops.audit_base(spark.read.parquet(log.rest))


def waitlist_report(spark: SparkSession, log: BucketedLog, states: DataFrame) -> DataFrame:
    """R2 with no exchange of the bucketed log: what is shuffled are counts per group and
    the waitlisted applications of first actions."""
    cold, rest = read_log(spark, log)
    faw = ops.first_action_waitlist(cold, colocated=True).unionByName(ops.first_action_waitlist(rest))
    return waitlist.report_from_base(waitlist.base_from(cold.unionByName(rest), faw, states))
