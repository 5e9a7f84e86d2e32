"""Keys that several groups of documents share, found without moving texts.

Documents are laid out in *lanes*: rows of a few MB of whole texts, in the order of
doc_id.  A lane names its keys once each, whatever its documents repeat, packed
as sorted binary columns per bucket; a bucket joins the lanes' keys and answers
each lane with the places of the keys it has in common with others.  A key that a
third of all documents share thus appears once per lane, and buckets hold a bounded
number of bytes because splitters deal them out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialise, materialise_by, prepare, text_or_empty

LANE_BYTES = 2 << 20  # a longer text is a lane of its own
ROW_BYTES = 16  # what a document counts beside its text, so that empty ones fill lanes too
LAST = 2**62  # order of lanes without doc_id

LANES = "lane long, ord long, ids array<long>, sizes array<long>, data binary"


def lanes(docs: DataFrame, lane_bytes: int = LANE_BYTES, *, buckets: int = 0) -> DataFrame:
    """``docs`` (doc_id, text) as a written table of lanes: ``ids`` and UTF-8
    ``sizes`` of the texts, ``data`` their bytes, ``ord`` rising with doc_id.  Equal
    ids share a lane, or fill lanes of their own that have one ``ord``; null ids come
    last, in lanes of one ``ord``.  With ``buckets`` the table lies in buckets of ``lane``."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    none = F.col("doc_id").isNull()
    spread = F.when(none, F.xxhash64("text")).otherwise(F.lit(0)).alias("spread")
    rows = rows.select(none.cast("int").alias("none"), "doc_id", spread, F.encode("text", "UTF-8").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "none", "doc_id", "spread").sortWithinPartitions("none", "doc_id", "spread")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def gather(batches: Batches) -> Batches:
        ids: list = []
        texts: list[bytes] = []
        size = number = part = 0

        order = None  # of the lanes that the last id fills alone

        def lane(upto: int) -> pa.RecordBatch:
            """The first ``upto`` texts as a lane; the others stay."""
            nonlocal ids, texts, size, number
            at = (part << 20) | number
            place = LAST if ids[0] is None else at if order is None else order
            out = pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([place], pa.int64()),
                 pa.array([ids[:upto]], pa.list_(pa.int64())), pa.array([[len(t) for t in texts[:upto]]], pa.list_(pa.int64())),
                 pa.array([b"".join(texts[:upto])], pa.binary())],
                ["lane", "ord", "ids", "sizes", "data"],
            )
            ids, texts, number = ids[upto:], texts[upto:], number + 1
            size = sum(len(t) + ROW_BYTES for t in texts)
            return out

        for b in batches:
            for part, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                if ids and doc != ids[-1] and (order is not None or ids[-1] is None or doc is None):
                    yield lane(len(ids))  # the lanes of one id, or of ids before the null ones, end
                    order = None
                elif size and size + len(text) > lane_bytes:
                    if doc is not None and doc == ids[-1]:
                        if ids[0] != doc:  # what lies before the id
                            yield lane(ids.index(doc))
                        if order is None:
                            order = (part << 20) | number
                    if size and size + len(text) > lane_bytes:
                        yield lane(len(ids))
                ids.append(doc)
                texts.append(text)
                size += len(text) + ROW_BYTES
        if ids:
            yield lane(len(ids))

    made = ordered.mapInArrow(gather, LANES)
    return materialise_by(made, "lanes", "lane", buckets) if buckets else materialise(made, "lanes")


class Lane:
    """One row of the lanes table as arrays."""

    def __init__(self, lane: int, ids: list, sizes: list, data: bytes):
        self.lane, self.ids = lane, ids
        self.data = np.frombuffer(data, np.uint8)
        self.at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.array(sizes, np.int64), out=self.at[1:])
        # equal ids (and all null ids) have equal ranks
        change = [False, *(a != b for a, b in zip(ids, ids[1:]))]
        self.rank = np.cumsum(np.array(change[: len(ids)], np.int64))


def route(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The bucket of each leading key: how many splitters it reaches."""
    return np.searchsorted(splitters, keys, "right").astype(np.int64)


def sampled_splitters(samples: DataFrame, n_buckets: int) -> np.ndarray:
    """``n_buckets - 1`` splitters from a sample of leading keys (long, unsigned
    order).  The sample only balances the buckets; at most a million keys of it
    reach the driver."""
    rows = samples.orderBy(F.xxhash64("key")).limit(1_000_000).collect()
    keys = np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    if not len(keys) or n_buckets < 2:
        return np.zeros(0, np.uint64)
    at = (np.arange(1, n_buckets) * len(keys)) // n_buckets
    return np.unique(keys[at])


def answers(named: DataFrame, answer, n_partitions: int) -> DataFrame:
    """(lane, replies): for each lane the buckets' answers.

    ``named``: (bucket, lane, ord, keys binary).  ``answer(lane, ord, keys)`` gets
    parallel lists for one bucket and yields (position in the lists, reply bytes)."""

    def run(t: pa.Table) -> pa.Table:
        columns = [t.column(c).to_pylist() for c in ("lane", "ord", "keys")]
        bucket = t.column("bucket")[0].as_py() if t.num_rows else 0
        out = list(answer(*columns))
        return pa.table({
            "lane": pa.array([columns[0][i] for i, _ in out], pa.int64()),
            "bucket": pa.array([bucket] * len(out), pa.int64()),
            "reply": pa.array([r for _, r in out], pa.binary()),
        })

    replies = (
        named.repartition(n_partitions, "bucket").groupBy("bucket")
        .applyInArrow(run, "lane long, bucket long, reply binary")
    )
    return replies.groupBy("lane").agg(F.collect_list(F.struct("bucket", "reply")).alias("replies"))
