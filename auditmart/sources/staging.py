"""Staging and warehouse loads.

The source copied every operational table serially on one node, dropping
binary columns and cutting some long text columns.  Here text stays whole unless
the caller names a column and its limit, and the copy is a
partitioned Spark job: a parallel read (Parquet splits, or JDBC range
partitions via :func:`read_jdbc_partitioned`), column-wise transforms that
stay in codegen, and a parallel write.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros
from .tables import TableRef, read_table, write_table


def staging_projection(df: DataFrame, text_limits: dict[str, int] | None = None) -> DataFrame:
    """W0 transform: drop binary columns and cut the string columns named in
    ``text_limits`` to that many characters; everything else passes whole."""
    limits = text_limits or {}
    unknown = [c for c in limits if c not in df.columns or not isinstance(df.schema[c].dataType, T.StringType)]
    if unknown:
        raise ValueError(f"no text column {unknown}; have {df.columns}")
    return df.select(*(
        F.substring(F.col(f.name), 1, limits[f.name]).alias(f.name) if f.name in limits else F.col(f.name)
        for f in df.schema.fields
        if not isinstance(f.dataType, T.BinaryType)
    ))


def stage_full_copy(
    spark: SparkSession,
    source: TableRef | str,
    target: TableRef | str,
    text_limits: dict[str, int] | None = None,
) -> DataFrame:
    """Initial (full) load of one table into staging, idempotent
    (``overwrite``).  Returns the staged table as read back."""
    staged = staging_projection(read_table(spark, source), text_limits)
    write_table(staged, target, mode="overwrite")
    return read_table(spark, target)


def stage_tables(
    spark: SparkSession,
    sources: dict[str, TableRef | str],
    target_root: str,
    text_limits: dict[str, dict[str, int]] | None = None,
    parallel_jobs: int = 4,
) -> dict[str, str]:
    """W0 for a whole source database: every table is staged under
    ``target_root/<name>`` (overwrite).  Each copy is one parallel Spark job
    (scan splits in, files out); up to ``parallel_jobs`` copies are submitted
    at once from driver threads, so small tables do not leave the cluster
    idle.  Only job handles pass through the driver.  ``text_limits``: per table,
    its text limits by column.  Returns the staged locations."""
    from concurrent.futures import ThreadPoolExecutor

    root = target_root.rstrip("/")

    def copy(item):
        name, source = item
        target = f"{root}/{name}"
        write_table(staging_projection(read_table(spark, source), (text_limits or {}).get(name)), target, mode="overwrite")
        return name, target

    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        return dict(pool.map(copy, sources.items()))


def denormalize(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    carry: Sequence[str],
) -> DataFrame:
    """Copy parent columns (e.g. program and season ids) onto a child
    table so reports save a join.  A left join keeps every child row; the
    parent side must be unique on its key (the warehouse does not enforce it,
    tests do).  Spark picks broadcast or sort-merge by size; AQE splits a
    skewed child key."""
    par = parent.select(F.col(parent_key).alias(child_key), *carry)
    return child.join(par, child_key, "left").select(*child.columns, *carry)


_MISSING = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def existing_table(spark: SparkSession, target: TableRef | str) -> DataFrame | None:
    """The target, or None where nothing has been staged yet.  Told by Spark's
    error class, so a mistyped database is an error and not a full reload."""
    try:
        return read_table(spark, target)
    except AnalysisException as exc:
        if (exc.getCondition() or "").split(".")[0] in _MISSING:
            return None
        raise


def high_watermark(existing: DataFrame, ts_col: str) -> Column | None:
    """Largest ``ts_col`` as a literal of its own type, or None if there is no
    dated row.  It travels as microseconds, so no time zone can shift it."""
    micros = existing.agg(F.max(epoch_micros(ts_col)).alias("wm")).first()["wm"]
    if micros is None:
        return None
    text = (datetime(1970, 1, 1) + timedelta(microseconds=micros)).isoformat(sep=" ")
    instant = isinstance(existing.schema[ts_col].dataType, T.TimestampType)
    return F.lit(text + "+00:00").cast("timestamp") if instant else F.lit(text).cast("timestamp_ntz")


def incremental_load(
    spark: SparkSession,
    source: DataFrame,
    target: TableRef | str,
    keys: Sequence[str],
    ts_col: str | None = None,
    text_limits: dict[str, int] | None = None,
) -> None:
    """Append the source rows whose key the target does not hold yet, so
    late, tied and undated rows are staged once each over any number of runs.

    ``keys`` identify a row (nulls compare equal).  ``ts_col`` is for sources that
    only ever add rows with newer or equal timestamps, or none: then the scan is
    pruned to rows at or after the target's high watermark and undated ones, and the
    anti-join meets only that end of the target."""
    existing = existing_table(spark, target)
    batch = source
    if existing is not None:
        if ts_col is not None and (since := high_watermark(existing, ts_col)) is not None:
            recent = F.col(ts_col).isNull() | (F.col(ts_col) >= since)
            batch, existing = batch.where(recent), existing.where(recent)
        held = existing.select(*(F.col(k).alias(f"_held_{k}") for k in keys))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys))
        batch = batch.join(held, same, "left_anti")
    write_table(staging_projection(batch, text_limits), target, mode="append")
