"""Operator 8, document fingerprints: a randomised edit embedding.

A walk reads a text: at step j it writes the character it stands on and moves
on if a random bit shared by all texts, drawn for (j, character), is 1.  Two texts
a few edits apart soon stand on the same characters again, so their edit distance
shows as a Hamming distance of the written strings (2 n steps for n characters).

A fingerprint samples the written string.  Slot b looks at the position that is
least under hash b among the first 2 n, so texts of nearly equal length look at
the same place, and keeps 16 bits of the characters written there and of the place.
The share of equal slots estimates the share of the embedding that agrees.
Near pairs are found by banding the slots and verified on all of them."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialise, mix, prepare, text_or_empty

SLOTS = 64
RUN = 8  # written characters a slot looks at
BAND = 4  # slots per band of near_pairs
GATHER = 12_000_000  # code points walked together by one task
CELLS = 32_000_000  # written characters held at once

_EMPTY = "0" * (4 * SLOTS)
_FIRST = -(2**63)


@lru_cache(maxsize=1)
def _records() -> list[tuple[np.ndarray, ...]]:
    """Per slot the positions that are less than all before them, up to 2**40:
    after a minimum u the next comes a geometric(u) number of steps later."""
    out = []
    for slot in range(SLOTS):
        rng = np.random.default_rng([17, slot])
        at, least, found = 0, rng.random(), []
        while at < 2**40:
            found.append(at)
            at += int(min(2.0**41, np.ceil(np.log(max(rng.random(), 1e-300)) / np.log1p(-least))))
            least *= rng.random()
        out.append(np.array(found, np.int64))
    return out


def _positions(steps: np.ndarray) -> np.ndarray:
    """[text, slot]: where each slot looks in the first ``steps`` (> 0)."""
    return np.stack([r[np.searchsorted(r, steps, "left") - 1] for r in _records()], axis=1)


def fingerprints(texts: list[str]) -> np.ndarray:
    """[text, slot] 16-bit samples of the embeddings; an empty text has zeros."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), SLOTS), np.uint16)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    begin = 0
    while begin < len(order):
        steps = 2 * int(sizes[order[begin]]) + RUN
        group = order[begin : begin + max(1, CELLS // steps)]
        out[group] = _walk([texts[i] for i in group], sizes[group])
        begin += len(group)
    return out


def _walk(texts: list[str], sizes: np.ndarray) -> np.ndarray:
    """Texts of falling length, walked together step by step."""
    flat = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    end = at + sizes
    steps = 2 * sizes + RUN
    written = np.zeros((int(steps[0]), len(texts)), np.uint16)
    active = len(texts)
    for block in range(0, int(steps[0]), 4096):
        many = min(4096, int(steps[0]) - block)
        odd = mix(np.arange(block, block + many, dtype=np.uint64)) | np.uint64(1)
        for j in range(many):
            while steps[active - 1] <= block + j:
                active -= 1
            here = at[:active]
            c = flat[here]
            written[block + j, :active] = c
            move = ((c.astype(np.uint64) + np.uint64(1)) * odd[j]) >> np.uint64(63)
            here += (move.astype(np.int64)) & (here < end[:active])
    looks = _positions(2 * sizes)
    value = looks.astype(np.uint64)
    lanes = np.arange(len(texts))[:, None]
    for i in range(RUN):
        value = mix(value * np.uint64(31) + written[looks + i, lanes])
    return (value >> np.uint64(48)).astype(np.uint16)


def to_hex(samples: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in samples]


def likeness(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Share of equal slots; an empty text is like empty ones only."""
    share = (a == b).mean(axis=1)
    return np.where((n_a == 0) | (n_b == 0), ((n_a == 0) & (n_b == 0)).astype(float), share)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_chars`` and ``fingerprint`` of a text column."""
    prepare(docs.sparkSession)
    rows = docs.drop("n_chars", "fingerprint").withColumn(text, text_or_empty(text))
    schema = rows.withColumn("n_chars", F.lit(0).cast("long")).withColumn("fingerprint", F.lit("")).schema
    at = rows.columns.index(text)

    def run(batches: Batches) -> Batches:
        for b in batches:
            texts = b.column(at).to_pylist()
            columns = [*b.columns, pa.array([len(t) for t in texts], pa.int64()), pa.array(to_hex(fingerprints(texts)))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def near_pairs(prints: DataFrame, node: str = "doc_id", least: float = 0.8, band: int = BAND) -> DataFrame:
    """(a, b, likeness) between different fingerprints of which at least the
    share ``least`` of slots agree; a < b are the least ``node`` of their
    fingerprint.  Bands of ``band`` slots propose the pairs (a share of 0.8 misses
    all 16 bands with probability 0.0003), all slots verify them."""
    one = prints.where("n_chars > 0").groupBy("fingerprint").agg(F.min(node).alias("node"))
    bands = F.array(*(
        F.xxhash64(F.lit(i), F.substring("fingerprint", 4 * band * i + 1, 4 * band)) for i in range(SLOTS // band)
    ))
    keyed = one.select("node", "fingerprint", F.explode(bands).alias("band"))
    other = keyed.select(F.col("node").alias("b"), F.col("fingerprint").alias("other"), "band")
    pairs = keyed.withColumnRenamed("node", "a").join(other, "band").where("a < b").select(
        "a", "b", "fingerprint", "other"
    ).distinct()
    same = sum(
        (F.substring("fingerprint", 4 * i + 1, 4) == F.substring("other", 4 * i + 1, 4)).cast("int") for i in range(SLOTS)
    )
    return pairs.select("a", "b", (same / F.lit(float(SLOTS))).alias("likeness")).where(F.col("likeness") >= least)


# --- each document against its edited text and the next document ------------------------

_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _order() -> list[Column]:
    return [F.desc("k"), F.desc("h"), F.desc("text")]


def compare_edited(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its fingerprint, that of its edited text, and how like
    it is to the edited text and to the next document.

    The next document follows in descending doc_id (ties by hash of the text;
    null ids come last), after the last comes the first.  Rows are range-dealt into
    buckets by that order; each bucket gets a copy of the next one's first row,
    so neighbours meet in one task and nothing is sorted whole.  Null texts
    count as empty; a single document follows itself; repeated rows follow each
    other; extra columns are ignored; an empty table gives no rows."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("k"),
        text_or_empty().alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the first key of every range: one row per partition reaches the driver
    firsts = (
        rows.select("k", "h").repartitionByRange(n, F.desc("k"), F.desc("h")).groupBy(F.spark_partition_id())
        .agg(F.max(F.struct("k", "h")).alias("first")).select("first.*").distinct().collect()
    )
    firsts = sorted(((r["k"], r["h"]) for r in firsts), reverse=True)
    if not firsts:
        return spark.createDataFrame([], _RESULT)
    by_bucket = [(k, h, (i - 1) % len(firsts)) for i, (k, h) in enumerate(firsts)]
    heads = spark.createDataFrame(by_bucket, "k long, h long, bucket int")
    ends = np.array([k for k, _ in firsts][::-1], np.int64)  # ascending

    @F.pandas_udf("int")
    def bucket_of(k, h):
        import pandas as pd

        ks, hs = k.to_numpy(), h.to_numpy()
        lo, hi = np.searchsorted(ends, ks, "left"), np.searchsorted(ends, ks, "right")
        out = len(ends) - hi - 1  # first keys above k, less one
        for i in np.flatnonzero(hi > lo):  # first keys with this very id: the hash decides
            out[i] += sum(firsts[len(ends) - 1 - j][1] >= hs[i] for j in range(lo[i], hi[i]))
        return pd.Series(out.astype(np.int32))

    dealt = rows.withColumn("bucket", bucket_of("k", "h")).withColumn("last", F.lit(0))
    # heads: one row per partition, bounded by their number
    next_first = rows.join(F.broadcast(heads), ["k", "h"]).groupBy("bucket", "k", "h").agg(
        F.max("text").alias("text")
    ).select(F.lit(None).cast("long").alias("doc_id"), "k", "text", "h", "bucket", F.lit(1).alias("last"))
    ordered = (
        dealt.unionByName(next_first).repartitionByRange(n, "bucket")
        .sortWithinPartitions("bucket", "last", *_order()).select("doc_id", "text", "bucket", "last")
    )

    def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows for all but the last text, which is only the others' next."""
        m = len(ids)
        changed = [edited(t, f) for t, f in zip(texts[:m], texts[1:])]
        samples = fingerprints(texts + changed)
        own, after, alt = samples[:m], samples[1 : m + 1], samples[m + 1 :]
        n_own, n_alt = np.array([len(t) for t in texts]), np.array([len(t) for t in changed])
        columns = [
            pa.array(ids, pa.int64()), pa.array(n_own[:m], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
            pa.array(to_hex(own)), pa.array(to_hex(alt)),
            pa.array(likeness(own, alt, n_own[:m], n_alt)), pa.array(likeness(own, after, n_own[:m], n_own[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RESULT.split(", ")])

    def run(batches: Batches) -> Batches:
        ids, texts, size = [], [], 0
        for b in batches:
            for doc, text, last in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                texts.append(text)
                size += len(text)
                if last or size > GATHER:
                    if ids:
                        yield compare(ids, texts)
                    ids, texts, size = ([], [], 0) if last else ([doc], [text], len(text))
                else:
                    ids.append(doc)

    return ordered.mapInArrow(run, _RESULT)
