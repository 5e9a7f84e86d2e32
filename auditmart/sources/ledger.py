"""Writes that a retried job cannot repeat: a ledger of committed batches.

The default write mode is append, as in the source, so a job that is run again after a
failure adds its rows again.  Here a write carries a batch id.  A batch lives in its
own partition folder of the target, which a retry overwrites, and counts only from the
moment its id stands in the ledger; a batch that stands there is not written again.
Readers take the committed batches alone, so the rows of a half-written batch
are never seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import existing_table
from .tables import write_table

LEDGER = "_ledger"  # beside the batches; readers of the folder pass it over
BATCH = "batch_id"


def _ledger(target: str) -> str:
    return f"{target.rstrip('/')}/{LEDGER}"


def _folder(target: str, batch_id: str) -> str:
    return f"{target.rstrip('/')}/{BATCH}={batch_id}"


def committed(spark: SparkSession, target: str) -> list[str]:
    """Ids of the committed batches, in the order of their names: one short string
    per load, never data."""
    entries = existing_table(spark, _ledger(target))
    return [] if entries is None else sorted(r[BATCH] for r in entries.select(BATCH).distinct().collect())


def write_batch(df: DataFrame, target: str, batch_id: str) -> bool:
    """Write ``df`` as batch ``batch_id`` of ``target`` and commit it.  False, and
    nothing written, if the batch is committed already.

    What a failed attempt left is overwritten; the ledger's entry is a file of its own
    whose write is the commit.  One writer per batch id at a time."""
    if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id):
        raise ValueError(f"a batch id is made of letters, digits, '-', '_' and '.': {batch_id!r}")
    if BATCH in df.columns:
        raise ValueError(f"column {BATCH} is the ledger's own")
    spark = df.sparkSession
    if batch_id in committed(spark, target):
        return False
    write_table(df, _folder(target, batch_id), mode="overwrite")
    entry = spark.createDataFrame([(batch_id,)], f"{BATCH} string").withColumn("committed_at", F.current_timestamp())
    write_table(entry.coalesce(1), _ledger(target))
    return True


def read_batches(spark: SparkSession, target: str, with_id: bool = False) -> DataFrame | None:
    """The rows of all committed batches (None before the first commit), with the batch's
    id as a column if wanted."""
    ids = committed(spark, target)
    if not ids:
        return None
    schema = spark.read.parquet(_folder(target, ids[0])).schema
    rows = spark.read.schema(schema).option("basePath", target).parquet(*(_folder(target, i) for i in ids))
    if with_id:
        return rows.withColumn(BATCH, F.col(BATCH).cast("string"))
    return rows.select(*schema.names)
