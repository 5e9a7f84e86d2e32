"""Operator 6, suffix-array dedup of repeated byte strings.

Every 50-byte string that also starts in a document with a smaller doc_id is
removed.  Sorting all suffixes would move each text 50 times, so the suffix array is
sparse: among the suffixes starting inside a 50-byte string, the one whose leading
``SEED`` bytes hash least is its sample, equal strings have equal samples, and
about one suffix in 16 is one.  Sampled suffixes are dealt to buckets by sampled
splitters on their leading bytes; inside a bucket hashes stand for the bytes: suffixes
are ordered by the hash of their seed and of their context and compared with their
neighbours, which come from all lanes.  (Equal strings have equal leading bytes and so
one bucket: nothing is left to compare across bucket edges.)

Each sample stands for the strings around it.  If all lanes that know a seed
have it in one context, the strings in it are equal and only the order of the lanes
matters.  Seeds met in several contexts (where a copied passage begins or ends) go
to a second round, in which every 50-byte string around them is a suffix of its own,
dealt, sorted and compared the same way."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, discard, materialise, mix, prepare, rolling_hashes, signed, span_hashes
from .shared_keys import Lane, answers, lanes, route, sampled_splitters

LENGTH = 50
SEED = 20
BUCKET_BYTES = 32 << 20  # text bytes per bucket
SAMPLE_BYTES = 64 << 10  # leading bytes of every lane the splitters are sampled from

_SINGLE, _DOUBLE = np.dtype([("seed", "<u4"), ("context", "<u8")]), np.dtype([("a", "<u8"), ("b", "<u2")])
_SEVERAL = np.uint64(0xFFFFFFFFFFFFFFFF)
_EARLIER, _MIXED = 1, 2


def _sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of every run of ``width`` entries."""
    out, done = x, 1
    while done < width:
        step = min(done, width - done)
        out, done = take(out[:-step], out[step:]), done + step
    return out


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number (zeros past
    the end): the order of the suffixes' first tokens."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(len(at), np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[at + i].astype(np.uint64)
    return key


def _in_buckets(bucket: np.ndarray, key: np.ndarray, tie: np.ndarray | None = None) -> np.ndarray:
    """An order by bucket and, inside it, by ``key`` and ``tie``."""
    order = np.argsort(key)
    if tie is not None:
        k, t = key[order], tie[order]
        if ((k[1:] == k[:-1]) & (t[1:] != t[:-1])).any():
            order = np.lexsort((tie, key))
    return order[np.argsort(bucket[order].astype(np.uint32), kind="stable")]


class Suffixes:
    """The sampled suffixes of a lane and what the first round says of its strings."""

    def __init__(self, lane: Lane, splitters: np.ndarray, length: int = LENGTH, seed: int = SEED):
        self.lane, self.length, self.splitters = lane, length, splitters
        self.width = length - seed + 1
        data, n = lane.data, len(lane.data)
        # strings that lie in one document
        self.valid = np.zeros(n, bool)
        for a, b in zip(lane.at[:-1].tolist(), lane.at[1:].tolist()):
            self.valid[a : max(a, b - length + 1)] = True
        self.start = np.zeros(0, np.int64)
        if n < length:
            return
        hashes = rolling_hashes(data, seed)
        self.least = np.full(n, np.uint64(0), np.uint64)
        m = _sliding(hashes, self.width, np.minimum)  # m[i]: least seed inside string i
        self.least[: len(m)] = m
        seen = np.where(self.valid[: len(m)], m, np.uint64(0))
        most = _sliding(np.concatenate([np.zeros(self.width - 1, np.uint64), seen, np.zeros(self.width - 1, np.uint64)]),
                        self.width, np.maximum)[: len(hashes)]
        self.start = np.flatnonzero((most == hashes) & (hashes > 0))
        self.seed = hashes[self.start]
        self.doc = np.searchsorted(lane.at, self.start, "right") - 1
        left = np.maximum(self.start - (self.width - 1), lane.at[self.doc])
        right = np.minimum(self.start + length, lane.at[self.doc + 1])
        self.context = mix(span_hashes(data, left, right) + (self.start - left).astype(np.uint64)) >> np.uint64(1)
        self.bucket = route(leading(data, self.start), splitters)

    def singles(self) -> list[tuple[int, np.ndarray]]:
        """Per bucket the lane's distinct seeds, sorted, with their context
        (or that there are several)."""
        if not len(self.start):
            return []
        seed = (self.seed >> np.uint64(32)).astype(np.uint32)
        order = _in_buckets(self.bucket, seed)
        b, s, c = self.bucket[order], seed[order], self.context[order]
        new = np.ones(len(b), bool)
        new[1:] = (b[1:] != b[:-1]) | (s[1:] != s[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        context = np.minimum.reduceat(c, first)
        several = context != np.maximum.reduceat(c, first)
        # of each sampled suffix: its group, and whether an earlier document has it
        self.group = np.zeros(len(b), np.int64)
        self.group[order] = group
        rank = self.lane.rank[self.doc]
        self.later = rank > np.minimum.reduceat(rank[order], first)[self.group]
        self.several = several
        keys = np.zeros(len(first), _SINGLE)
        keys["seed"], keys["context"] = s[first], np.where(several, _SEVERAL, context)
        self.cut = np.searchsorted(b[first], np.arange(len(self.splitters) + 2))
        return [(k, keys[i:j]) for k, (i, j) in enumerate(zip(self.cut, self.cut[1:])) if j > i]

    def _strings(self, pick: np.ndarray) -> np.ndarray:
        """Which strings have one of the picked suffixes as their sample."""
        at, seed = self.start[pick], self.seed[pick]
        found = np.zeros(len(self.valid), bool)
        for d in range(self.width):
            i = at - d
            ok = i >= 0
            ok[ok] = self.valid[i[ok]] & (self.least[i[ok]] == seed[ok])
            found[i[ok]] = True
        return found

    def settle(self, replies: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Take the first round's answers, by start of the string: which strings are
        removed, and which become suffixes of the second round."""
        if not len(self.start):
            return np.zeros(len(self.valid), bool), np.zeros(len(self.valid), bool)
        self.singles()
        state = np.zeros(len(self.several), np.uint8)
        for bucket, reply in replies:
            at = np.frombuffer(reply[: len(reply) // 5 * 4], "<u4").astype(np.int64)
            state[self.cut[bucket] + at] = np.frombuffer(reply[len(reply) // 5 * 4 :], np.uint8)
        state[self.several] = _MIXED
        mine = state[self.group]
        removed = self._strings(np.flatnonzero((mine == _EARLIER) | ((mine == 0) & self.later)))
        return removed, self._strings(np.flatnonzero(mine == _MIXED)) & ~removed


class Strings:
    """The strings of a lane that the first round left open, as suffixes of their own."""

    def __init__(self, lane: Lane, open_: bytes, splitters: np.ndarray, length: int = LENGTH):
        self.lane, self.length, self.splitters = lane, length, splitters
        self.at = np.flatnonzero(_bits(open_, len(lane.data)))

    def doubles(self) -> list[tuple[int, np.ndarray]]:
        """Per bucket the distinct strings, sorted."""
        at = self.at
        if not len(at):
            return []
        data = self.lane.data
        a = span_hashes(data, at, at + self.length)
        b = (span_hashes(data, at, at + self.length // 2) >> np.uint64(48)).astype(np.uint16)
        bucket = route(leading(data, at), self.splitters)
        order = _in_buckets(bucket, a, b)
        k, x, y = bucket[order], a[order], b[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(new)
        self.group = np.zeros(len(k), np.int64)
        self.group[order] = np.cumsum(new) - 1
        rank = self.lane.rank[np.searchsorted(self.lane.at, at, "right") - 1]
        self.later = rank > np.minimum.reduceat(rank[order], first)[self.group]
        keys = np.zeros(len(first), _DOUBLE)
        keys["a"], keys["b"] = x[first], y[first]
        self.cut = np.searchsorted(k[first], np.arange(len(self.splitters) + 2))
        return [(q, keys[i:j]) for q, (i, j) in enumerate(zip(self.cut, self.cut[1:])) if j > i]

    def finish(self, removed: bytes, replies: list[tuple[int, bytes]]) -> np.ndarray:
        """Which bytes of the lane are removed, from the strings removed in the first round
        and the second round's answers."""
        gone = _bits(removed, len(self.lane.data))
        if self.doubles():
            earlier = np.zeros(int(self.cut[-1]), bool)
            for bucket, reply in replies:
                earlier[self.cut[bucket] + np.frombuffer(reply, "<u4").astype(np.int64)] = True
            gone[self.at[earlier[self.group] | self.later]] = True
        covered = np.zeros(len(gone) + self.length + 1, np.int32)
        at = np.flatnonzero(gone)
        covered[at] += 1
        covered[at + self.length] -= 1
        return np.cumsum(covered)[: len(gone)] > 0


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _merge(lane: list[int], order: list[int], keys: list[bytes], kind: np.dtype):
    """All keys of a bucket in order, with their lane's number,
    order and place, and where runs of an equal first token begin."""
    parts = [np.frombuffer(k, kind) for k in keys]
    all_keys = np.concatenate(parts)
    sizes = [len(p) for p in parts]
    owner = np.repeat(np.arange(len(parts)), sizes)
    place = np.concatenate([np.arange(s) for s in sizes])
    rank = np.array(order, np.int64)[owner]
    first, second = kind.names
    at = np.lexsort((rank, all_keys[second], all_keys[first]))
    return all_keys[at], owner[at], place[at].astype("<u4"), rank[at]


def _compare_singles(lane: list[int], order: list[int], keys: list[bytes]):
    k, owner, place, rank = _merge(lane, order, keys, _SINGLE)
    new = np.ones(len(k), bool)
    new[1:] = k["seed"][1:] != k["seed"][:-1]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k)) - 1
    mixed = ((k["context"][first] != k["context"][last]) | (k["context"][last] == _SEVERAL))[group]
    state = np.where(mixed, _MIXED, np.where(rank > rank[first][group], _EARLIER, 0)).astype(np.uint8)
    state[(first == last)[group]] = 0
    hit = np.flatnonzero(state)
    by_owner = hit[np.argsort(owner[hit], kind="stable")]
    cut = np.searchsorted(owner[by_owner], np.arange(len(lane) + 1))
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            yield i, place[by_owner[a:b]].tobytes() + state[by_owner[a:b]].tobytes()


def _compare_doubles(lane: list[int], order: list[int], keys: list[bytes]):
    k, owner, place, rank = _merge(lane, order, keys, _DOUBLE)
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    group = np.cumsum(new) - 1
    hit = np.flatnonzero(rank > rank[np.flatnonzero(new)][group])
    by_owner = hit[np.argsort(owner[hit], kind="stable")]
    cut = np.searchsorted(owner[by_owner], np.arange(len(lane) + 1))
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            yield i, place[by_owner[a:b]].tobytes()


def _named(found: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
         pa.array([f[2] for f in found], pa.int64()), pa.array([f[3].tobytes() for f in found], pa.binary())],
        ["bucket", "lane", "ord", "keys"],
    )


_NAMED = "bucket long, lane long, ord long, keys binary"
_STATE = "lane long, removed binary, open binary"
_RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:bigint,end:bigint>>"
)


def _rows(b: pa.RecordBatch):
    """(Lane, row) of each row of a batch of lanes with further columns."""
    for row in b.to_pylist():
        yield Lane(row["lane"], row["ids"], row["sizes"], row.pop("data")), row


def _replies(row: dict) -> list[tuple[int, bytes]]:
    return [(r["bucket"], r["reply"]) for r in row["replies"] or []]


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the
    removed ``spans`` (start and end byte).

    A null text is empty.  Strings never cross documents and are judged on the
    input.  A null doc_id is larger than any other and null ids do not remove from
    each other; neither do repeated rows of one doc_id; extra columns are ignored;
    an empty table gives no rows.  A text of any length is read whole, in one lane.

    Lanes lie in buckets of their number, so that of the two rounds only keys and
    answers are shuffled; what a step wrote goes when the next has read it."""
    spark = prepare(docs.sparkSession)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    laid = lanes(docs, buckets=n)
    total = laid.agg(F.sum(F.length("data"))).first()[0] or 0

    def sample(batches: Batches) -> Batches:
        for b in batches:
            for lane, _ in _rows(b):
                found = Suffixes(lane, np.zeros(0, np.uint64), length, seed)
                keys = leading(lane.data, found.start)
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys[:: max(1, len(keys) // 200)]))], ["key"])

    heads = laid.select(
        "lane", F.array(F.lit(None).cast("long")).alias("ids"),
        F.array(F.least(F.length("data"), F.lit(SAMPLE_BYTES)).cast("long")).alias("sizes"),
        F.substring("data", 1, SAMPLE_BYTES).alias("data"),
    )
    splitters = sampled_splitters(heads.mapInArrow(sample, "key long"), -(-total // BUCKET_BYTES))

    def first(batches: Batches) -> Batches:
        for b in batches:
            for lane, row in _rows(b):
                found = Suffixes(lane, splitters, length, seed).singles()
                yield _named([(k, lane.lane, row["ord"], keys) for k, keys in found])

    def settle(batches: Batches) -> Batches:
        for b in batches:
            for lane, row in _rows(b):
                state = Suffixes(lane, splitters, length, seed).settle(_replies(row))
                packed = [pa.array([np.packbits(x).tobytes()], pa.binary()) for x in state]
                yield pa.RecordBatch.from_arrays([pa.array([lane.lane], pa.int64()), *packed], ["lane", "removed", "open"])

    def second(batches: Batches) -> Batches:
        for b in batches:
            for lane, row in _rows(b):
                found = Strings(lane, row["open"], splitters, length).doubles()
                yield _named([(k, lane.lane, row["ord"], keys) for k, keys in found])

    def finish(batches: Batches) -> Batches:
        for b in batches:
            for lane, row in _rows(b):
                strings = Strings(lane, row["open"], splitters, length)
                yield _result(lane, strings.finish(row["removed"], _replies(row)))

    # the lanes stay where they are at every size, whatever the other side would allow
    one = materialise(answers(laid.mapInArrow(first, _NAMED), _compare_singles, n), "first_answers")
    state = materialise(laid.join(one.hint("merge"), "lane", "left").mapInArrow(settle, _STATE), "first_state")
    discard(one)
    opened = laid.join(state.hint("merge"), "lane")
    two = materialise(answers(opened.mapInArrow(second, _NAMED), _compare_doubles, n), "second_answers")
    out = materialise(opened.join(two.hint("merge"), "lane", "left").mapInArrow(finish, _RESULT), "kept")
    discard(laid, state, two)
    return out


def _result(lane: Lane, gone: np.ndarray) -> pa.RecordBatch:
    out = []
    for doc, a, b in zip(lane.ids, lane.at[:-1].tolist(), lane.at[1:].tolist()):
        cut = gone[a:b]
        edges = np.diff(cut.astype(np.int8), prepend=0, append=0)
        spans = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        kept = hashlib.sha256(lane.data[a:b][~cut].tobytes()).hexdigest()
        out.append((doc, b - a, int(cut.sum()), len(spans), kept, [{"start": s, "end": e} for s, e in spans]))
    columns = list(zip(*out)) or [()] * 6
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64()] * 4 + [pa.string(), span]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
