"""Table scan and table write.

The source connector took a table name plus connection options.  Here a table
is addressed by a :class:`TableRef`: a format (``parquet``, ``orc``,
``delta`` … anything ``DataFrameReader.format`` knows), a path or catalog name,
and reader / writer options.  JDBC is just ``format="jdbc"`` with the usual
``url``/``dbtable`` options; a partitioned JDBC read is available through
:func:`read_jdbc_partitioned`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCRATCH: set[str] = set()  # applications whose scratch folder exists
WRITE_MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


@dataclass(frozen=True)
class TableRef:
    """Where a table lives.  ``catalog=True`` means ``location`` is a table
    name in the session catalog rather than a path."""

    location: str
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    catalog: bool = False


def as_ref(table: TableRef | str) -> TableRef:
    return table if isinstance(table, TableRef) else TableRef(table)


def read_table(spark: SparkSession, table: TableRef | str) -> DataFrame:
    """Scan a whole table.  Column pruning and filter pushdown are left to
    Catalyst: callers select / filter on the returned DataFrame and the Parquet
    scan only reads what they use."""
    ref = as_ref(table)
    if ref.catalog:
        return spark.read.options(**ref.options).table(ref.location)
    reader = spark.read.format(ref.fmt).options(**ref.options)
    if ref.fmt == "jdbc":
        return reader.load()
    return reader.load(ref.location)


def read_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: dict | None = None,
) -> DataFrame:
    """Parallel JDBC scan: ``num_partitions`` range queries on a numeric
    column instead of one serial cursor (the source copied tables serially on a
    single node)."""
    opts = {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
    }
    opts.update(properties or {})
    return spark.read.format("jdbc").options(**opts).load()


def split_points(keys: DataFrame, column: str, num_partitions: int, accuracy: int = 100_000) -> list:
    """Cut values that deal the rows of ``keys`` into ``num_partitions`` ranges of about
    equal numbers of rows, from a quantile sketch of ``column`` (one aggregate, merged
    map-side; rank error at most rows / ``accuracy``).  Fewer come back where a value
    holds more than a range's rows: equal values cannot be split."""
    if num_partitions < 2:
        return []
    shares = [i / num_partitions for i in range(1, num_partitions)]
    cuts = keys.agg(F.percentile_approx(column, shares, accuracy)).first()[0]
    return sorted(set(cuts or []))


def _sql_literal(value) -> str:
    text = str(value)
    return text if isinstance(value, (int, float)) else "'" + text.replace("'", "''") + "'"


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """SQL conditions that deal all rows to the ranges (.., c1], (c1, c2], .. (cn, ..);
    nulls go to the first.  Every row meets exactly one."""
    if not cuts:
        return ["1 = 1"]
    c = [_sql_literal(v) for v in cuts]
    first = f"{column} <= {c[0]} OR {column} IS NULL"
    middle = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(c, c[1:])]
    return [first, *middle, f"{column} > {c[-1]}"]


def read_jdbc_split(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    cuts: Sequence,
    properties: dict | None = None,
) -> DataFrame:
    """Parallel JDBC scan over ranges that hold equal numbers of rows.  Even steps
    between two bounds (:func:`read_jdbc_partitioned`) leave a skewed key to one task;
    here ``cuts`` are :func:`split_points` of the key, from the last staged copy of the
    table or from a query for the key column alone."""
    return spark.read.jdbc(url, table, predicates=range_predicates(partition_column, cuts), properties=properties or {})


def cluster(df: DataFrame, sortkeys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """S2 in memory: lay rows out by a compound sort key.

    The source asked the warehouse for a distribution key and compound sort
    key; on a read those options have no effect on the rows.  The Spark
    counterpart of that layout is a range partitioning on the compound key:
    unlike ``repartition(distkey)`` it splits a hot distribution key across
    partitions by the following sort keys, so one program holding a third of
    the log does not land in one task.  Rows are unchanged (bag-equal)."""
    keys = [F.col(k).asc_nulls_first() for k in sortkeys]
    if num_partitions is None:
        ranged = df.repartitionByRange(*keys)
    else:
        ranged = df.repartitionByRange(num_partitions, *keys)
    return ranged.sortWithinPartitions(*sortkeys)


def read_clustered(
    spark: SparkSession,
    table: TableRef | str,
    distkey: str,
    sortkeys: Sequence[str],
    num_partitions: int | None = None,
) -> DataFrame:
    """Scan with distribution key + compound sort key layout."""
    keys = list(sortkeys) if distkey in sortkeys else [distkey, *sortkeys]
    return cluster(read_table(spark, table), keys, num_partitions)


def write_table(
    df: DataFrame,
    table: TableRef | str,
    mode: str = "append",
    partition_by: Iterable[str] = (),
) -> None:
    """S3: write a DataFrame.  The default mode is ``append`` like the source
    connector, so a rerun adds rows; pass ``overwrite`` for idempotent jobs."""
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    ref = as_ref(table)
    writer = df.write.format(ref.fmt).options(**ref.options).mode(mode)
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    if ref.catalog:
        writer.saveAsTable(ref.location)
    elif ref.fmt == "jdbc":
        writer.save()
    else:
        writer.save(ref.location)


def write_clustered(
    df: DataFrame,
    table: str,
    distkey: str,
    sortkeys: Sequence[str],
    num_buckets: int,
    mode: str = "append",
    fmt: str = "parquet",
) -> None:
    """S2 on write: persist the layout as Spark bucketing on the distribution
    key and the compound sort key together, sorted inside the buckets, so a hot
    distribution key (a program holding a third of the log) is spread over the
    buckets by its other keys.  Rows are dealt to tasks the way buckets are, so
    each bucket is one file; aggregations on the whole key need no shuffle."""
    keys = list(dict.fromkeys([distkey, *sortkeys]))
    (
        df.repartition(num_buckets, *keys)
        .write.format(fmt)
        .mode(mode)
        .bucketBy(num_buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder: the checkpoint directory the session
    names in ``spark.checkpoint.dir``.  Only a local-mode session without one
    (tests) gets a temporary folder; on a cluster it is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server owns the folder
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return conf.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        # a machine-local folder is not shared by executors
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    import tempfile

    sc.setCheckpointDir(tempfile.mkdtemp(prefix="auditmart-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused location under :func:`shared_dir`.  Everything
    below the application's scratch folder is deleted when the driver's JVM ends,
    so no copy outlives its job."""
    base = f"{shared_dir(spark)}/auditmart-{_application(spark)}"
    return f"{base}/{purpose}/{uuid.uuid4().hex}"


def scratch_copy(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a scratch table and read back: lineage is cut, and later plans
    know the table's size."""
    path = scratch_path(df.sparkSession, purpose)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _application(spark: SparkSession) -> str:
    """The application id; on the first call its scratch folder is made and
    handed to the file system for deletion at exit."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's folder is cleaned there
        return "connect"
    app = sc.applicationId
    if app not in _SCRATCH:
        _SCRATCH.add(app)
        folder = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/auditmart-{app}")
        files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return app
