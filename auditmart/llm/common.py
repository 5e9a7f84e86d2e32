"""Shared helpers of the text operators: session set-up, written intermediates,
word hashing over Arrow batches and connected components."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import read_table, scratch_path

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to the executors once per session and keep Arrow
    batches small, so that a batch of very long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_auditmart_shipped", False):
        return spark
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="auditmart-ship-"), "auditmart.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("auditmart", os.path.relpath(path, package)))
    sc.addPyFile(target)
    sc._auditmart_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs: Spark deletes them once
    neither Python nor the JVM holds the plans, which else may take long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: lineage is
    cut, and a lost executor costs no recomputation of what lies before."""
    path = scratch_path(df.sparkSession, f"llm/{purpose}")
    release(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    release(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def materialise_by(df: DataFrame, purpose: str, key: str, buckets: int) -> DataFrame:
    """Like ``materialise``, in buckets of ``key``: a join on ``key`` moves the other side
    only.  A bucketed table needs a name in the catalog; ``discard`` takes it out again."""
    spark, name = df.sparkSession, f"auditmart_{uuid.uuid4().hex}"
    path = scratch_path(spark, f"llm/{purpose}")
    release(spark)
    (
        df.repartition(buckets, key).write.option("compression", "zstd").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )
    release(spark)
    out = spark.table(name)
    out._written_to, out._table = path, name
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from ``materialise`` or ``materialise_by`` once all
    that reads them is written itself, so that disk holds the steps still needed and no
    more.  A later loss of an executor needs none of them."""
    for df in tables:
        if name := df.__dict__.get("_table"):
            df.sparkSession.sql(f"DROP TABLE {name}")
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# --- hashing ---------------------------------------------------------------------

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # the longest asked for so far


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_P, _P_INV)):
            table = np.full(n + n // 8, base, np.uint64)
            table[0] = 1
            _POWERS[i] = np.cumprod(table)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span ``data[start:end]``, equal for equal
    bytes wherever they stand: prefix sums of byte codes times powers of an odd
    constant, scaled back to the start of the span."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def rolling_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """``span_hashes`` of every run of ``width`` bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    raw = sums[width:] - sums[:-width]
    raw *= down[: len(raw)]
    raw += np.uint64(width)
    return mix(raw)


class Words:
    """The words of a batch of texts: runs of letters, digits and other
    non-ASCII bytes and ``_``, lower-cased; ``hashes`` of all words, ``first[i]``
    the index of text i's first word (one more entry at the end), ``starts`` and
    ``ends`` their byte offsets in ``data`` (lower-cased UTF-8, newline-joined)
    and ``text_at[i]`` the offset of text i."""

    def __init__(self, texts: Sequence[str], lower: bool = True):
        raw = [(t.lower() if lower else t).encode("utf-8", "replace") for t in texts]
        lengths = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        self.data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
        self.text_at = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(lengths, out=self.text_at[1:])
        inside = _WORD_BYTE[self.data]
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.text_at)


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words inside one text, in text order,
    and the index of each text's first one.  A text of 1 .. size-1 words has one
    shingle of all its words, a text without words none."""
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=first[1:])
    if not len(words.hashes):
        return np.zeros(0, np.uint64), first
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    text = np.repeat(np.arange(len(n)), count)
    at = words.first[text] + np.arange(first[-1]) - first[text]
    out = np.full(len(at), size, np.uint64)
    for i in range(size):
        within = at + i < words.first[text + 1]
        out = mix(out * np.uint64(_P) + np.where(within, padded[at + i], np.uint64(i + 1)))
    return out, first


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long of the same bits (Spark has no unsigned long)."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


Batches = Iterator[pa.RecordBatch]


# --- connected components ----------------------------------------------------------


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for every node of ``edges``: label = least node of the
    connected component.  Alternating large-star / small-star steps; every step
    is joins and map-side combined minima, and is written to the shared folder."""

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).distinct()
    e = materialise(e, "components")
    nodes = e.select(F.col("hi").alias("node")).union(e.select(F.col("lo").alias("node"))).distinct()
    before = state(e)
    while before[0]:
        both = e.union(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        e = materialise(
            small.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(least.select("hi", F.col("m").alias("lo"))).distinct(),
            "components",
        )
        after = state(e)
        if after == before:
            break
        before = after
    return nodes.join(e, nodes["node"] == e["hi"], "left").select("node", F.coalesce("lo", "node").alias("label"))
