"""A table of value ranges per file, kept beside a stored Parquet table.

Spark skips row groups by their footers, but it opens every file to learn them.
With the least and greatest value of some columns recorded per file, a reader
leaves out whole files before anything is opened: an incremental load meets only the
staged files that may hold one of its keys (:func:`indexed_load`), and a filter on any
column of an interleaved layout reads only the files it can touch (:func:`read_where`).

The ranges are themselves a Parquet table, in a folder of the target whose name
begins with ``_`` so that readers of the target pass it over.  It is never needed for a
right result: a file without an entry is always read, an entry without a file is ignored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros
from .staging import existing_table, staging_projection
from .tables import cluster, write_table

RANGES = "_file_ranges"
MAX_BOXES = 128  # boxes that a batch's keys are reduced to


def comparable(name: str, kind: T.DataType) -> Column:
    """The column as a number or string of the same order, so that its ranges can be
    stored and compared as plain values whatever the session's time zone."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    if isinstance(kind, (T.FractionalType, T.StringType, T.BooleanType)):
        return F.col(name)
    raise ValueError(f"no order for column {name} of type {kind.simpleString()}")


def choose(column: Column, bounds: Sequence[Any]) -> Column:
    """How many of the ascending ``bounds`` are at most the value, by a balanced
    tree of comparisons (a null counts none)."""

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column >= F.lit(bounds[mid]), between(mid + 1, hi)).otherwise(between(lo, mid))

    return between(0, len(bounds))


# --- the ranges of a table ---------------------------------------------------------------


def _one_name(path: Column) -> Column:
    """A path as one spelling: listings and scans write the slashes after the scheme
    differently."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def _listed(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, path): the files as listed, and the name that their ranges go by."""
    return spark.createDataFrame([(f,) for f in files], "file string").withColumn("path", _one_name(F.col("file")))


def _location(target: str) -> str:
    return f"{target.rstrip('/')}/{RANGES}"


def table_files(spark: SparkSession, target: str) -> list[str]:
    """Paths of the files the target consists of (the listing any read makes)."""
    existing = existing_table(spark, target)
    return [] if existing is None else existing.inputFiles()


def known_ranges(spark: SparkSession, target: str) -> DataFrame | None:
    return existing_table(spark, _location(target))


def measure(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(path, n_rows, n_bytes, and per column lo_, hi_ and nulls_) for every file that
    ``files`` reads.  Only the columns are read; every task sends a row per file."""
    values = [comparable(c, files.schema[c].dataType).alias(c) for c in columns]
    rows = files.select(_one_name(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("_size"), *values)
    out = []
    for c in columns:
        out += [
            F.min(c).alias(f"lo_{c}"),
            F.max(c).alias(f"hi_{c}"),
            F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{c}"),
        ]
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"), F.max("_size").alias("n_bytes"), *out)


def index_files(spark: SparkSession, target: str, columns: Sequence[str]) -> None:
    """Record the ranges of those files of ``target`` that have none yet, so after
    a load only what it wrote is read."""
    files = table_files(spark, target)
    ranges = known_ranges(spark, target)
    if ranges is not None:
        files = [r["file"] for r in _listed(spark, files).join(ranges.select("path"), "path", "left_anti").collect()]
    if files:
        # a file without rows gets an entry too, one that no box meets
        counts = ["n_rows", "n_bytes", *(f"nulls_{c}" for c in columns)]
        new = _listed(spark, files).select("path").join(measure(spark.read.parquet(*files), columns), "path", "left")
        write_table(new.fillna(0, counts).coalesce(1), _location(target))  # a row per file


def _overlaps(box: dict[str, tuple[Any, Any, bool]]) -> Column:
    """Files that may hold a row inside the box: per column (least, greatest, with
    nulls); a null least means no value but null."""
    tests = []
    for c, (lo, hi, nulls) in box.items():
        some = F.lit(False) if lo is None else (F.col(f"hi_{c}") >= F.lit(lo)) & (F.col(f"lo_{c}") <= F.lit(hi))
        tests.append(F.coalesce(some, F.lit(False)) | (F.col(f"nulls_{c}") > 0 if nulls else F.lit(False)))
    return reduce(and_, tests)


@dataclass(frozen=True)
class Selection:
    """The files of a table that a reader needs, out of how many."""

    paths: list[str]
    n_files: int
    bytes_read: int  # of those with an entry
    bytes_known: int


def select_files(spark: SparkSession, target: str, boxes: Iterable[dict[str, tuple[Any, Any, bool]]]) -> Selection:
    """The files of ``target`` that may hold a row of one of ``boxes``, and all files
    without an entry.  The driver gets paths, which any read of them needs."""
    files = table_files(spark, target)
    ranges = known_ranges(spark, target)
    boxes = list(boxes)
    if ranges is None or not files:
        return Selection(files, len(files), 0, 0)
    wanted = reduce(or_, map(_overlaps, boxes)) if boxes else F.lit(False)
    # a file indexed twice by a repeated job has two equal entries
    entries = ranges.dropDuplicates(["path"]).withColumn("_wanted", wanted)
    found = _listed(spark, files).join(entries.select("path", "n_bytes", "_wanted"), "path", "left")
    rows = found.where("_wanted OR n_bytes IS NULL").select("file", F.coalesce("n_bytes", F.lit(0)).alias("n")).collect()
    known = found.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return Selection([r["file"] for r in rows], len(files), sum(r["n"] for r in rows), known)


# --- incremental load by key ------------------------------------------------------------------


def key_boxes(batch: DataFrame, keys: Sequence[str], ranges: DataFrame) -> list[dict[str, tuple[Any, Any, bool]]]:
    """The batch's keys as at most ``MAX_BOXES`` + 1 boxes that hold them all.  The first
    key's values are cut where the target's files begin, so a single late key makes a
    small box of its own.  One map-side combined aggregate over the batch."""
    n_files = ranges.count()
    first = f"lo_{keys[0]}"
    cuts = ranges.where(F.col(first).isNotNull()).select(first).repartitionByRange(max(1, min(MAX_BOXES, n_files)), first)
    bounds = sorted(r["lo"] for r in cuts.groupBy(F.spark_partition_id().alias("p")).agg(F.min(first).alias("lo")).collect())
    values = batch.select(*(comparable(k, batch.schema[k].dataType).alias(k) for k in keys))
    bin_of = F.when(F.col(keys[0]).isNull(), F.lit(-1)).otherwise(choose(F.col(keys[0]), bounds))
    sides = [a for k in keys for a in (F.min(k).alias(f"lo_{k}"), F.max(k).alias(f"hi_{k}"), F.max(F.col(k).isNull()).alias(f"null_{k}"))]
    rows = values.groupBy(bin_of.alias("_bin")).agg(*sides).collect()
    return [{k: (r[f"lo_{k}"], r[f"hi_{k}"], r[f"null_{k}"]) for k in keys} for r in rows]


@dataclass(frozen=True)
class LoadReport:
    """What a load met of its target: files read of how many, and their bytes."""

    files_read: int
    files: int
    bytes_read: int
    bytes_known: int


def indexed_load(
    spark: SparkSession,
    batch: DataFrame,
    target: str,
    keys: Sequence[str],
    text_limits: dict[str, int] | None = None,
) -> LoadReport:
    """W2 for a batch of changed or new rows: append those whose key the target does
    not hold (nulls compare equal), reading only the target's files that may hold
    one of them.

    What the load reads of the target grows with the batch's spread over the key
    ranges, not with the target: new rows are written clustered by key, so every file
    covers a narrow range of it.  For keys without any order in time (random ids)
    every batch spreads over all files, and the load reads the key columns of all of
    them, as :func:`~auditmart.sources.staging.incremental_load` does.

    The batch is read three times (boxes, anti-join and the write's range sampling):
    hand over a staged table, not a query against a source system."""
    keys = list(keys)
    existing = existing_table(spark, target)
    selection = Selection([], 0, 0, 0)
    if existing is not None:
        ranges = known_ranges(spark, target)
        boxes = key_boxes(batch, keys, ranges) if ranges is not None else []
        selection = select_files(spark, target, boxes)
        if selection.paths:
            held = spark.read.schema(existing.schema).parquet(*selection.paths)
            held = held.select(*(F.col(k).alias(f"_held_{k}") for k in keys))
            same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys))
            batch = batch.join(held, same, "left_anti")
    write_table(cluster(staging_projection(batch, text_limits), keys), target, mode="append")
    index_files(spark, target, keys)
    return LoadReport(len(selection.paths), selection.n_files, selection.bytes_read, selection.bytes_known)


# --- interleaved layout -----------------------------------------------------------------------


LEVELS = 6  # bits of each column in the interleaved key


def _number(name: str, kind: T.DataType) -> Column:
    """A number of (nearly) the column's order: strings by their first 7 bytes."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    return comparable(name, kind)


def interleaved_key(df: DataFrame, columns: Sequence[str], levels: int = LEVELS) -> Column:
    """A long that gives every column the same say in the order of rows (Z-order).

    Each column is cut into at most ``2**levels`` ranges with equal numbers of rows
    (a quantile sketch over all of them in one aggregate), so neither skew nor a
    column of few values wastes bits; the bits of the range numbers are dealt out
    in turn, highest first.  Nulls come first."""
    if levels * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {levels} bits do not fit a long")
    shares = [i / 2**levels for i in range(1, 2**levels)]
    numbers = {c: _number(c, df.schema[c].dataType) for c in columns}
    sketch = df.agg(*(
        F.struct(F.min(n).alias("least"), F.percentile_approx(n, shares, 10_000).alias("cuts")).alias(c)
        for c, n in numbers.items()
    )).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        bounds = sorted({b for b in sketch[c]["cuts"] or [] if b > sketch[c]["least"]})
        rank = F.when(numbers[c].isNull(), F.lit(0)).otherwise(choose(numbers[c], bounds))
        scaled = F.floor(rank * F.lit(2**levels) / F.lit(len(bounds) + 1)).cast("long")
        for bit in range(levels):
            place = bit * len(columns) + (len(columns) - 1 - i)
            key = key.bitwiseOR(F.shiftleft(F.shiftright(scaled, bit).bitwiseAND(F.lit(1)), place))
    return key


def interleave(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """S2 for several access paths: rows range-partitioned and sorted by the interleaved
    key of ``columns``.  A compound key prunes on its first column only; here a
    filter on any one of them leaves most partitions out.  Rows are unchanged."""
    keyed = df.withColumn("_interleaved", interleaved_key(df, columns))
    ranged = keyed.repartitionByRange(num_partitions, "_interleaved") if num_partitions else keyed.repartitionByRange("_interleaved")
    return ranged.sortWithinPartitions("_interleaved").drop("_interleaved")


def write_interleaved(
    df: DataFrame, target: str, columns: Sequence[str], num_files: int | None = None, mode: str = "overwrite"
) -> None:
    """Store ``df`` in the interleaved layout and record the ranges of its files."""
    write_table(interleave(df, columns, num_files), target, mode)
    index_files(df.sparkSession, target, columns)


def read_where(spark: SparkSession, target: str, bounds: dict[str, tuple[Any, Any]]) -> DataFrame:
    """The rows of ``target`` whose columns lie within ``bounds`` (column -> least and
    greatest value, both included; plain numbers, strings or dates), from the
    files that may hold any."""
    existing = existing_table(spark, target)
    if existing is None:
        raise ValueError(f"no table at {target}")
    kinds = {c: existing.schema[c].dataType for c in bounds}
    box = {c: (*_plain(spark, kinds[c], pair), False) for c, pair in bounds.items()}
    paths = select_files(spark, target, [box]).paths
    rows = spark.read.schema(existing.schema).parquet(*paths) if paths else existing.limit(0)
    tests = [F.col(c).between(F.lit(lo).cast(kinds[c]), F.lit(hi).cast(kinds[c])) for c, (lo, hi) in bounds.items()]
    return rows.where(reduce(and_, tests))


def _plain(spark: SparkSession, kind: T.DataType, pair: tuple[Any, Any]) -> tuple[Any, Any]:
    """The bounds as the values that ranges are stored as."""
    row = spark.range(1).select(*(F.lit(v).cast(kind).alias(f"v{i}") for i, v in enumerate(pair)))
    return tuple(row.select(*(comparable(f"v{i}", kind).alias(f"v{i}") for i in (0, 1))).first())
