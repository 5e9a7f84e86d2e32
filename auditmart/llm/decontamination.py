"""Operator 9, benchmark decontamination by spaced-seed hashing.

A fixed mask over consecutive words ("1" counts, "0" is ignored) is hashed at
every word of the test items and of the documents.  Equal hashes put a document
and an item on one diagonal; the words along it are then compared, and the longest
run of at least ``MIN_WORDS`` words with at least ``IDENTITY`` of them equal is
an overlap.  Substituted words cost a mismatch, not the hit.

The masks lose no such run.  A fifth of its words differ at most, so they leave four
equal words in a row, or else they part it evenly into threes (15 words, 3 of them
changed), which the second mask meets.  Items shorter than ``MIN_WORDS`` may be left
with less and have masks of their own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, Words, mix, prepare, text_or_empty

MASKS = ("1111", "1110111")
SHORT_MASKS = {5: ("11011", "11101", "10111"), 6: ("111011", "110111"), 10: ("111011",)}  # by size of the item
MIN_WORDS = 13  # shortest overlap; a shorter item must be met whole
SHORTEST_ITEM = 5  # items of fewer words are no evidence and are never met
IDENTITY = 0.8
BLOCK_WORDS = 1_000_000  # test words broadcast at once; more go in further passes
PART = 1_000_000  # seed hits, or compared words, looked at together

_COEFFICIENTS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of ``mask`` laid at each position that has room for it."""
    n = max(0, len(hashes) - len(mask) + 1)
    out = np.full(n, len(mask), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out += hashes[i : i + n] * _COEFFICIENTS[i]
    return mix(out)


class Index:
    """Seeds of a block of test items."""

    def __init__(self, ids: list[int], texts: list[str], masks: tuple[str, ...]):
        words = Words(texts)
        self.ids, self.hashes, self.first = ids, words.hashes, words.first
        sizes = np.diff(words.first)
        spans = {mask: None for mask in masks}  # the sizes of the items, None for all
        for n, short in SHORT_MASKS.items():
            for mask in short if (sizes == n).any() else ():
                spans[mask] = None if mask in masks else {*(spans.get(mask) or ()), n}
        for n in range(SHORTEST_ITEM, max(map(len, masks))):
            if (sizes == n).any():
                spans.setdefault("1" * n, {n})
        self.masks = []
        for mask, only in sorted(spans.items()):
            seeds = _seeds(self.hashes, mask)
            at = np.arange(len(seeds))
            item = np.searchsorted(self.first, at, "right") - 1
            fits = at + len(mask) <= self.first[item + 1]
            fits &= (sizes[item] >= SHORTEST_ITEM) if only is None else np.isin(sizes[item], list(only))
            seeds, at, item = seeds[fits], at[fits], item[fits]
            order = np.argsort(seeds, kind="stable")
            seeds = seeds[order]
            bits = max(10, int(16 * len(seeds)).bit_length())
            filled = np.zeros(1 << bits, bool)
            filled[(seeds >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.masks.append((mask, seeds, at[order], item[order], np.uint64(64 - bits), filled))

    def overlaps(self, words: Words):
        """(text, item, start, item_start, span, matched), the best per text
        and item; starts and spans count words."""
        hits = []
        for mask, seeds, at, item, shift, filled in self.masks:
            own = _seeds(words.hashes, mask)
            near = np.flatnonzero(filled[(own >> shift).astype(np.int64)])
            lo, hi = np.searchsorted(seeds, own[near], "left"), np.searchsorted(seeds, own[near], "right")
            near, lo, count = near[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            cut = np.cumsum(count)
            for a, b in _parts(cut):
                n = count[a:b]
                k = np.repeat(lo[a:b] - (cut[a:b] - n), n) + np.arange(cut[b - 1] - n.sum(), cut[b - 1])
                p = np.repeat(near[a:b], n)
                text = np.searchsorted(words.first, p, "right") - 1
                hits.append(np.unique(np.stack([text, item[k], p - at[k]]), axis=1))
        if not hits:
            return
        text, item, diagonal = np.unique(np.concatenate(hits, axis=1), axis=1)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for i in self._enough(words, text, item, diagonal).tolist():
            pair = int(text[i]), int(item[i])
            best[pair] = max(best.get(pair, (0, 0, 0, 0)), self._along(words, *pair, int(diagonal[i])))
        for (text, item), (matched, span, start, item_start) in best.items():
            if matched:
                yield text, self.ids[item], start, item_start, span, matched

    def _enough(self, words: Words, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """The hits whose whole diagonal has as many equal words as the shortest
        overlap needs."""
        lo = np.maximum(self.first[item], words.first[text] - diagonal)
        hi = np.minimum(self.first[item + 1], words.first[text + 1] - diagonal)
        need = IDENTITY * np.minimum(MIN_WORDS, self.first[item + 1] - self.first[item]) - 1e-9
        out = np.zeros(len(text), bool)
        cut = np.cumsum(hi - lo)  # a hit's diagonal is never empty
        for a, b in _parts(cut):
            n = (hi - lo)[a:b]
            begin = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(lo[a:b] - begin, n)
            same = words.hashes[at + np.repeat(diagonal[a:b], n)] == self.hashes[at]
            out[a:b] = np.add.reduceat(same.astype(np.int64), begin) >= need[a:b]
        return np.flatnonzero(out)

    def _along(self, words: Words, text: int, item: int, diagonal: int) -> tuple[int, int, int, int]:
        """The longest run on a diagonal with the required share of equal words;
        words that differ at its ends are left off as far as it stays long enough."""
        t0, t1 = int(words.first[text]), int(words.first[text + 1])
        q0, q1 = int(self.first[item]), int(self.first[item + 1])
        lo, hi = max(q0, t0 - diagonal), min(q1, t1 - diagonal)
        if hi <= lo:
            return 0, 0, 0, 0
        need = min(MIN_WORDS, q1 - q0)
        same = words.hashes[lo + diagonal : hi + diagonal] == self.hashes[lo:hi]
        sums = np.concatenate([[0.0], np.cumsum(same - IDENTITY)])
        # the last place that is not below a start's, for every start
        high = np.maximum.accumulate(sums[::-1])[::-1]
        ends = np.searchsorted(-high, 1e-9 - sums, "right") - 1
        begin = int(np.argmax(ends - np.arange(len(sums))))
        end = int(ends[begin])
        if end - begin < need:
            return 0, 0, 0, 0
        while end - begin > need and not same[end - 1]:
            end -= 1
        while end - begin > need and not same[begin]:
            begin += 1
        return int(same[begin:end].sum()), end - begin, lo + begin + diagonal - t0, lo + begin - q0


def _parts(cut: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows with about ``PART`` entries each; ``cut``: running entries."""
    if not len(cut):
        return []
    edges = np.searchsorted(cut, np.arange(PART, cut[-1], PART), "left") + 1
    edges = np.unique(np.concatenate([[0], edges, [len(cut)]])).tolist()
    return list(zip(edges[:-1], edges[1:]))


def _indexes(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...]):
    """The test items as broadcast seed indexes of about ``BLOCK_WORDS`` words."""
    spark = prepare(docs.sparkSession)
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    size = items.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_WORDS))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield spark.sparkContext.broadcast(Index([r[0] for r in part], [r[1] for r in part], masks))


def overlaps(docs: DataFrame, benchmark: DataFrame, keep: list[str], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """One row per document row and test item that overlap: the ``keep`` columns
    of the document and the best overlap's item_id, start_word, item_start_word,
    n_words and n_matched.

    Test items travel to the tasks in blocks of ``BLOCK_WORDS`` words, a pass over
    the documents per block, so the broadcast stays bounded.  Null and empty texts
    overlap nothing; items of fewer than ``SHORTEST_ITEM`` words are skipped; ties
    keep the longest, then the last, run; repeated rows give repeated results; an
    empty table gives no rows."""
    names = [*keep, "item_id", "start_word", "item_start_word", "n_words", "n_matched"]
    rows = docs.select(*keep, text_or_empty("text").alias("_text"))
    schema = docs.select(*keep, *(F.lit(0).cast("long").alias(n) for n in names[len(keep):])).schema
    out = None
    for shared in _indexes(docs, benchmark, masks):

        def run(batches: Batches, shared=shared) -> Batches:
            for b in batches:
                found = list(shared.value.overlaps(Words(b.column(len(keep)).to_pylist())))
                at = pa.array([f[0] for f in found], pa.int64())
                columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(1, 6)]
                yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[: len(keep)]), *columns], names)

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, item_start_word, n_words, n_matched)."""
    return overlaps(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, ["doc_id"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no test item, all columns.  The test
    runs row by row, so copies and null ids need no join."""
    at = docs.columns.index("text")
    for shared in _indexes(docs, benchmark, MASKS):

        def run(batches: Batches, shared=shared) -> Batches:
            for b in batches:
                texts = [t or "" for t in b.column(at).to_pylist()]
                hit = {f[0] for f in shared.value.overlaps(Words(texts))}
                yield b.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
