"""Operator 2, packing: mixture-controlled packing by deficit round-robin.

Every source is a queue of documents.  The token stream is a row of windows of
``window_sequences`` sequences.  In each window, every queue is served its share
of the window's tokens; what rounding leaves is carried as the queue's deficit
into the next window.  A queue that runs dry leaves its share to the others.

With fixed shares the round-robin has a closed form, so windows need no
sequential pass.  In virtual time ``v`` a queue is owed ``weight * v`` tokens and has
been served that number, rounded, up to its total.  Token j of a queue is thus due at
``(j + 1/2) / weight``, and the stream is all tokens by their due time, ties (in
floats) by queue.  Window w ends at the earliest time by which ``w * window`` tokens are due; of
those due at just that time the first queues' go in.  Served counts never fall from
one window to the next, however small a queue's share of a window is, and after
every window a queue's deficit is at most one token more than its share of half a
token per queue (no drift over the corpus).  Finding a window's end costs one pass
over the queues per bit of a float, whatever the number of windows.

Each document needs only its queue's offset: offsets inside an input
partition are counted while encoding, and the partitions' totals (one row per
partition and queue) are summed by a window, so a source holding a third of all
rows is never gathered in one task.

Documents are cut where a window's share or a sequence ends.  Only the end of the
stream can be shorter than a sequence; it is cut into sequences whose lengths
are powers of two, so there is no padding."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty
from .tokens import encoder, vocabulary_path

SEQUENCE = 4096
WINDOW_SEQUENCES = 64
MAX_QUEUES = 1024  # the smallest sources without a weight of their own share one queue beyond that
CACHE_BYTES = 16 << 20  # ends of windows that a task remembers
END_ID = 2

_REST = "\0rest"
_ENCODED = "doc_id long, queue string, lane int, lane_start long, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "`offset` long, source string, window_id long, ids binary"
)


def encode(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Encode each document once, with its offset among the documents of its
    source in the same input partition (``lane``)."""

    def run(batches: Batches) -> Batches:
        enc = encoder(vocabulary)
        lane = TaskContext.get().partitionId()
        served: dict = {}
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            ids = [x + end for x in enc.encode(b.column(2).to_pylist())]
            n = [len(x) // enc.dtype.itemsize for x in ids]
            starts = []
            for q, k in zip(b.column(1).to_pylist(), n):
                starts.append(served.get(q, 0))
                served[q] = starts[-1] + k
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([lane] * len(n), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "queue", "lane", "lane_start", "n", "ids"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue"),
        text_or_empty().alias("text"),
    )
    return rows.mapInArrow(run, _ENCODED)


class Phase:
    """Queues that are served together, by their weights."""

    def __init__(self, totals: list[int], weights: list[float]):
        self.totals = np.array(totals, np.int64)
        self.total = int(self.totals.sum())
        self.weights = np.array(weights, np.float64)
        if len(totals):
            self.weights = self.weights / self.weights.max()
        # a little later than the last token is due, so that rounding loses none
        self.end = float(((self.totals + 1) / self.weights).max()) if len(totals) else 0.0

    def due(self, v: float) -> np.ndarray:
        """Tokens of each queue that are due by the time ``v``."""
        return np.minimum(self.totals, np.floor(self.weights * v + 0.5).astype(np.int64))

    def served(self, goal: int) -> np.ndarray:
        """Tokens of each queue among the first ``goal`` tokens of the stream."""
        if goal >= self.total:
            return self.totals
        # positive floats are ordered like their bits: bisect to two neighbours
        low, high = 0, int(np.float64(self.end).view(np.int64))
        while high - low > 1:
            middle = (low + high) // 2
            if int(self.due(float(np.int64(middle).view(np.float64))).sum()) > goal:
                high = middle
            else:
                low = middle
        before = self.due(float(np.int64(low).view(np.float64)))
        tied = self.due(float(np.int64(high).view(np.float64))) - before
        room = np.clip(goal - int(before.sum()) - (np.cumsum(tied) - tied), 0, tied)
        return before + room

    def rank(self, i: int, token: int) -> int:
        """About where a queue's token stands in the stream."""
        return int(self.due((token + 0.5) / float(self.weights[i])).sum())


class Shares:
    """What each queue has been served after each window (see the module)."""

    def __init__(self, totals: dict[str, int], weights: dict[str, float] | None, window: int):
        self.window, self.total = window, sum(totals.values())
        self.last = max(0, -(-self.total // window) - 1)
        queues = sorted(q for q in totals if totals[q])
        weight = {q: float(totals[q]) if weights is None else float(weights.get(q, 0)) for q in queues}
        # queues without a weight are served when all others are dry
        first, late = [q for q in queues if weight[q] > 0], [q for q in queues if not weight[q] > 0]
        self.first = Phase([totals[q] for q in first], [weight[q] for q in first])
        self.late = Phase([totals[q] for q in late], [totals[q] for q in late])
        self.index = {q: i for i, q in enumerate([*first, *late])}
        self._ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def ends(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens served to each queue before window ``w``, and to all queues up to
        each one together."""
        if w not in self._ends:
            if len(self._ends) * 16 * len(self.index) > CACHE_BYTES:
                self._ends.clear()
            goal = min(w * self.window, self.total)
            late = self.late.served(goal - self.first.total) if goal > self.first.total else np.zeros_like(self.late.totals)
            served = np.concatenate([self.first.served(min(goal, self.first.total)), late])
            self._ends[w] = served, np.cumsum(served) - served
        return self._ends[w]

    def window_of(self, i: int, token: int) -> int:
        """The window that serves a queue's token."""
        n = len(self.first.totals)
        rank = self.first.rank(i, token) if i < n else self.first.total + self.late.rank(i - n, token)
        w = min(self.last, max(0, rank - 1) // self.window)
        while self.ends(w)[0][i] > token:
            w -= 1
        while self.ends(w + 1)[0][i] <= token:
            w += 1
        return w

    def cuts(self, queue: str, begin: int, end: int):
        """(queue offset, length, window, position in the stream) of the pieces
        of the tokens ``begin .. end-1`` of a queue, one per window."""
        i = self.index[queue]
        while begin < end:
            w = self.window_of(i, begin)
            (before, ahead), (after, ahead_after) = self.ends(w), self.ends(w + 1)
            n = min(end, int(after[i])) - begin
            yield begin, n, w, w * self.window + int(ahead_after[i] - ahead[i] - before[i]) + begin
            begin += n


def sequence_of(position: int, total: int, size: int) -> tuple[int, int, int]:
    """(sequence, offset, room left) of a stream position: sequences of ``size``
    tokens, the rest of the stream in sequences of falling powers of two."""
    full = total // size
    if position < full * size:
        return position // size, position % size, size - position % size
    sequence, begin, rest = full, full * size, total - full * size
    while True:
        length = 1 << (rest.bit_length() - 1)
        if position < begin + length:
            return sequence, position - begin, begin + length - position
        sequence, begin, rest = sequence + 1, begin + length, rest - length


def pack(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text, source).  Returns one row per
    piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    source, window_id`` and the piece's ``ids`` (little-endian uint16).

    ``weights``: target share of each source, any positive numbers; None: the
    sources' own shares, so that all queues end together.  Sources without a weight
    come last.  Every source in ``weights`` is a queue of its own, and so are the
    ``max_queues`` largest others; the rest are served as one queue with the sum of
    their shares, in mixed order (all their tokens are packed).  A null text
    counts as empty (its end id alone), a null source as the source ``""``;
    a null doc_id stays null; repeated rows are packed once each; a text longer
    than a window runs through several; extra columns are ignored; an empty table gives
    no rows."""
    spark = prepare(docs.sparkSession)
    encoded = materialise(encode(docs, vocabulary or vocabulary_path(), end_id), "packing")
    lanes = encoded.groupBy("queue", "lane").agg(F.sum("n").alias("n"))
    lanes = materialise(lanes, "packing_lanes")
    per_source = lanes.groupBy("queue").agg(F.sum("n").alias("n"))
    # the caller's sources and at most max_queues others reach the driver; the rest is one number
    weighted = spark.createDataFrame([(q,) for q in weights or {}], "queue string")
    largest = per_source.join(weighted, "queue", "left_anti").orderBy(F.desc("n"), "queue").limit(max_queues)
    own = per_source.join(weighted, "queue", "left_semi").union(largest).collect()
    totals = {r["queue"]: r["n"] for r in own}
    named = spark.createDataFrame([(q,) for q in totals], "queue string").withColumn("served_as", F.col("queue"))
    rest = (lanes.agg(F.sum("n")).first()[0] or 0) - sum(totals.values())
    if rest:
        totals[_REST] = rest
    shares = Shares(totals, weights, sequence * window_sequences)
    before = Window.partitionBy("served_as").orderBy(F.xxhash64("queue", "lane"), "queue", "lane")
    starts = lanes.join(F.broadcast(named), "queue", "left").withColumn(
        "served_as", F.coalesce("served_as", F.lit(_REST))
    ).withColumn("base", F.sum("n").over(before) - F.col("n"))
    # written, so that Spark knows its size: a few rows per source and input partition
    starts = materialise(starts.select("queue", "lane", "served_as", "base"), "packing_starts")
    rows = encoded.join(starts, ["queue", "lane"]).select(
        "doc_id", "queue", "served_as", (F.col("base") + F.col("lane_start")).alias("begin"), "n", "ids"
    )

    def place(batches: Batches) -> Batches:
        for b in batches:
            out: list[tuple] = []
            for doc, source, queue, begin, n, ids in zip(*(c.to_pylist() for c in b.columns)):
                width = len(ids) // n
                for at, length, window, position in shares.cuts(queue, begin, begin + n):
                    while length:
                        seq, offset, room = sequence_of(position, shares.total, sequence)
                        k, s = min(length, room), at - begin
                        part = ids[width * s : width * (s + k)]
                        crc = zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes())
                        out.append((doc, s, k, crc, n, seq, offset, source, window, part))
                        at, position, length = at + k, position + k, length - k
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source",
                     "window_id", "ids"]
            kinds = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary()]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(place, _PIECES)
