"""Operator 4, MinHash near-dedup by BagMinHash signatures.

A document is a bag of five-word shingles, a shingle's weight its number of
occurrences.  Every shingle owns Poisson processes over time, one for each dyadic
stretch [0,1), [1,2), [2,4), [4,8) .. of the weight axis with a rate of the
stretch's length; a point has a time, a place on the axis and a register.  A
document sees the points below its own weights, and register j keeps the earliest
time.  Two documents agree in a register with the probability of their weighted
Jaccard similarity, for any weights.  Only points before a horizon that fills
the registers are drawn, so a document costs its shingles plus about m log m points.

Bands of registers propose pairs.  A bucket's members are first compared with its
least one; members that this leaves in different classes are then compared with
each other, block by block, so no link is lost to the short cut.  Pairs are verified on the whole
bags of shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, Words, components, discard, materialise, mix, prepare, shingles, signed, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5  # 0.8 misses all bands with probability 0.0004
REGISTERS = BANDS * ROWS
# pairs whose signatures agree in fewer registers are not verified: at a
# similarity of 0.8 that happens with probability 3e-7 (five deviations)
LEAST_AGREEMENT = 0.6
PART_BYTES = 1 << 20  # of text that a task hashes at once
BLOCK_NODES, BLOCK_BYTES = 1000, 8 << 20  # members of a bucket, and their bags, per block


def _parts(batches: Batches, columns: tuple[int, ...]) -> Batches:
    """The batches cut so that the texts in ``columns`` hold at most ``PART_BYTES`` before the
    last row: hashing takes many times the memory of the text."""
    for b in batches:
        sizes = sum(np.array([len(t) for t in b.column(c).to_pylist()], np.int64) for c in columns)
        part = (np.cumsum(sizes) - sizes) // PART_BYTES
        cut = np.flatnonzero(np.diff(part)) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
            yield b.slice(i, j - i)


def bags(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, weight) of all texts, sorted by text and hash."""
    found, first = shingles(Words(texts), size)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], found[at], np.diff(np.append(at, len(found)))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, m: int = REGISTERS) -> np.ndarray:
    """[text, register] earliest times (float64); infinite for empty bags.
    ``weight`` may be any positive number."""
    totals = np.bincount(text, weight, n_texts)
    out = np.full((n_texts, m), np.inf)
    todo, factor = totals > 0, 1.0
    while todo.any():
        pick = todo[text]
        horizon = np.zeros(n_texts)
        horizon[todo] = factor * m * (np.log(m) + 4) / totals[todo]
        _draw(out.reshape(-1), text[pick], element[pick], weight[pick], horizon, m)
        todo &= np.isinf(out).any(axis=1)
        factor *= 2
    return out


def _draw(out: np.ndarray, text: np.ndarray, element: np.ndarray, weight: np.ndarray, horizon: np.ndarray, m: int) -> None:
    """Take the minimum over all points before the horizon into ``out``."""
    low, length = 0.0, 1.0
    while len(text):
        key = mix(element ^ mix(np.full(1, int(low), np.uint64) + np.uint64(77)))
        t, owner, top, stop = np.zeros(len(key)), text, weight, horizon[text]
        step = 0
        while len(key):
            step += 1
            first = mix(key + np.uint64(2 * step))
            t = t - np.log(((first >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / length
            live = t <= stop
            key, t, owner, top, stop = key[live], t[live], owner[live], top[live], stop[live]
            second = mix(key + np.uint64(2 * step + 1))
            seen = low + length * ((second >> np.uint64(32)).astype(np.float64) / 2.0**32) < top
            register = (second & np.uint64(0xFFFFFFFF)) % np.uint64(m)
            np.minimum.at(out, owner[seen] * m + register[seen].astype(np.int64), t[seen])
        low, length = low + length, 1.0 if low == 0 else 2 * length
        more = weight > low
        text, element, weight = text[more], element[more], weight[more]


def _agreement(a: list[bytes], b: list[bytes]) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(v), np.uint16).reshape(-1, REGISTERS) for v in (a, b))
    return (x == y).mean(axis=1)


def sign(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(row, sha, sig, bands) of (row, text): 16 bits per register and the band
    keys; a text without words has no bands."""

    def run(batches: Batches) -> Batches:
        for b in _parts(batches, (2,)):
            texts = b.column(2).to_pylist()
            text, element, weight = bags(texts, size)
            times = signatures(text, element, weight.astype(np.float64), len(texts))
            full = np.isfinite(times[:, 0])
            bits = mix(np.where(full[:, None], times, 0.0).view(np.uint64))
            keys = np.zeros((len(texts), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(31) + bits[:, r::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
            sig = (bits >> np.uint64(48)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([s.tobytes() for s in sig], pa.binary()),
                 pa.array([signed(k).tolist() if f else [] for k, f in zip(keys, full)], pa.list_(pa.int64()))],
                ["row", "sha", "sig", "bands"],
            )

    return rows.select("row", F.unhex(F.sha2("text", 256)).alias("sha"), "text").mapInArrow(
        run, "row long, sha binary, sig binary, bands array<long>"
    )


def likely(pairs: DataFrame, nodes: DataFrame, least: float = LEAST_AGREEMENT) -> DataFrame:
    """The (a, b) whose signatures agree in the share ``least`` of registers."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            keep = _agreement(b.column(2).to_pylist(), b.column(3).to_pylist()) >= least if b.num_rows else []
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sigs = nodes.select("node", "sig")
    return (
        pairs.join(sigs.toDF("a", "sig_a").hint("merge"), "a").join(sigs.toDF("b", "sig_b").hint("merge"), "b")
        .select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")
    )


def verify(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """The (a, b) whose bags of shingles have that weighted Jaccard similarity;
    ``texts``: (row, text) of at least the pairs' members, and where it has the
    columns ``is_a`` and ``is_b``, which side's texts each row is asked for."""

    def run(batches: Batches) -> Batches:
        for b in _parts(batches, (2, 3)):
            a_ids, b_ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            known = dict(zip(a_ids, b.column(2).to_pylist())) | dict(zip(b_ids, b.column(3).to_pylist()))
            number = {k: i for i, k in enumerate(known)}
            text, element, weight = bags(list(known.values()), size)
            cut = np.searchsorted(text, np.arange(len(known) + 1))
            keep = []
            for x, y in zip(a_ids, b_ids):
                p, q = (slice(cut[number[v]], cut[number[v] + 1]) for v in (x, y))
                _, i, j = np.intersect1d(element[p], element[q], assume_unique=True, return_indices=True)
                both = np.minimum(weight[p][i], weight[q][j]).sum()
                total = weight[p].sum() + weight[q].sum() - both
                keep.append(bool(total) and both >= similarity * total)
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a, b = (texts.where(side) if side in texts.columns else texts for side in ("is_a", "is_b"))
    return (
        pairs.join(a.select(F.col("row").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
        .join(b.select(F.col("row").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
        .select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")
    )


def expanded(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int) -> list[np.ndarray]:
    """Each bag as a sorted set: occurrence k of a shingle is an element of its
    own, so the overlap of bags is that of the sets."""
    owner = np.repeat(text, weight)
    first = np.repeat(np.cumsum(weight) - weight, weight)
    copy = (np.arange(len(owner)) - first).astype(np.uint64)
    sets = mix(np.repeat(element, weight) + copy * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((sets, owner))
    return np.split(sets[order], np.searchsorted(owner, np.arange(1, n_texts)))


def compare_buckets(
    placed: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE
) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different classes.

    ``placed``: (band, node, label).  Members are dealt to blocks of bounded size
    and every two blocks of a bucket meet in a task, so no pair becomes a row and
    no task holds a whole bucket.  Pairs whose signatures agree too little are left
    out; all others are compared on their whole bags.  A task returns the links that
    join classes it has not joined yet.  ``texts`` is read, and deleted, before this returns."""
    members = placed.select(F.col("node").alias("row")).distinct()

    def bag(batches: Batches) -> Batches:
        for b in _parts(batches, (1,)):
            found = b.column(1).to_pylist()
            sets = expanded(*bags(found, size), len(found)) if found else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "bag"])

    found = texts.select("row", "text").join(members.hint("merge"), "row", "left_semi").mapInArrow(bag, "node long, bag binary")
    found = materialise(found.join(nodes.select("node", "sig").hint("merge"), "node"), "bags")
    discard(texts)
    sizes = placed.join(found.select("node", F.length("bag").alias("bytes")), "node").groupBy("band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_NODES)), F.ceil(F.sum("bytes") / F.lit(BLOCK_BYTES)), F.lit(1))
        .cast("int").alias("blocks")
    )
    dealt = placed.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "node", "label", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )

    def compare(t: pa.Table) -> pa.Table:
        columns = {c: t.column(c).to_pylist() for c in ("node", "label", "block", "lo", "hi", "sig", "bag")}
        inner = columns["lo"][0] == columns["hi"][0]
        left = [i for i, x in enumerate(columns["block"]) if x == columns["lo"][0]]
        right = left if inner else [i for i, x in enumerate(columns["block"]) if x == columns["hi"][0]]
        sig = np.frombuffer(b"".join(columns["sig"]), np.uint16).reshape(-1, REGISTERS)
        sets = [np.frombuffer(x, np.uint64) for x in columns["bag"]]
        label = np.array(columns["label"], np.int64)
        out = []
        r_sets = [sets[j] for j in right]
        flat, n_right = np.concatenate(r_sets), np.array([len(x) for x in r_sets])
        begin = np.cumsum(n_right) - n_right
        r_sig, r_index = sig[right], np.array(right)
        for i in left:
            want = (label[r_index] != label[i]) & ((r_sig == sig[i]).mean(axis=1) >= LEAST_AGREEMENT)
            if inner:
                want &= r_index > i
            for part in np.array_split(np.flatnonzero(want), max(1, -(-int(want.sum()) // 512))):
                if not len(part):
                    continue
                at = np.concatenate([np.arange(begin[k], begin[k] + n_right[k]) for k in part])
                values, own = flat[at], sets[i]
                place = np.minimum(np.searchsorted(own, values), len(own) - 1)
                hits = (own[place] == values).astype(np.int64)
                cut = np.cumsum(n_right[part]) - n_right[part]
                both = np.add.reduceat(hits, cut)
                near = both >= similarity * (len(own) + n_right[part] - both)
                for k in part[near].tolist():
                    j = right[k]
                    if label[j] != label[i]:
                        out.append((columns["node"][i], columns["node"][j]))
                        label[label == label[j]] = label[i]
        ends = list(zip(*out)) or [(), ()]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return dealt.join(found.hint("merge"), "node").groupBy("band", "lo", "hi").applyInArrow(compare, "a long, b long")


def classes(rows: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """(row, class) for each of ``rows`` (row: unique long, text: not null): class
    is the least row of the connected component of equal texts and of pairs with
    the given similarity."""
    signed_rows = materialise(sign(rows, size), "signatures")
    ids = materialise(signed_rows.select("row", "sha"), "ids")
    copies = materialise(ids.groupBy("sha").agg(F.min("row").alias("node")), "copies")
    nodes = signed_rows.join(copies.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    nodes = materialise(nodes.select("node", "sig", "bands"), "nodes")
    discard(signed_rows)
    keyed = materialise(nodes.select("node", F.explode("bands").alias("band")), "bands")
    shared = keyed.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(shared, "shared_bands")
    heads = keyed.join(shared, "band").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    tested = materialise(likely(heads.distinct(), nodes), "pairs")
    # the texts of all that share a bucket are fetched once, by one shuffle of the
    # texts at every size (a broadcast would only suit small tables); those that
    # only head their buckets, or never do, are needed on one side of a pair alone
    sharing = keyed.join(shared.select("band"), "band", "left_semi").select(F.col("node").alias("row")).distinct()
    sides = tested.select(F.col("a").alias("row"), F.lit(True).alias("is_a"), F.lit(False).alias("is_b")).union(
        tested.select(F.col("b"), F.lit(False), F.lit(True))
    ).groupBy("row").agg(F.max("is_a").alias("is_a"), F.max("is_b").alias("is_b"))
    sharing = sharing.join(sides, "row", "left").na.fill(False, ["is_a", "is_b"])
    texts = materialise(rows.select("row", "text").join(sharing.hint("merge"), "row"), "candidate_texts")
    links = materialise(verify(tested, texts, similarity, size), "links")
    discard(tested)
    labels = materialise(components(links, "a", "b"), "labels")
    # buckets whose members are still in several classes
    placed = keyed.join(shared.select("band"), "band", "left_semi").join(labels, "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label")
    )
    mixed = placed.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("band")
    placed = materialise(placed.join(mixed, "band"), "mixed_bands")
    discard(keyed, shared)
    across = compare_buckets(placed, nodes, texts, similarity, size)
    links = links.union(materialise(across, "links"))
    discard(nodes, placed)
    labels = components(links, "a", "b")
    by_copy = copies.join(labels, "node", "left").select("sha", F.coalesce("label", "node").alias("class"))
    return ids.join(by_copy, "sha").select("row", "class")


def _rows(docs: DataFrame) -> DataFrame:
    """The documents with a unique row number, written so it stays theirs."""
    prepare(docs.sparkSession)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), whole), "documents")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) per row of ``docs``: class_id is the least doc_id of the
    document's class of exact and near copies.

    Null texts count as empty; empty texts are copies of each other, and a text
    of fewer than five words has one shingle of all its words; a null doc_id stays
    null and never names a class that has another id; repeated rows share a class;
    extra columns are ignored; an empty table gives no rows."""
    rows = _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    texts = rows.select("row", text_or_empty("whole.text").alias("text"))
    members = materialise(rows.select("row", "whole.doc_id").join(classes(texts), "row"), "classes")
    names = members.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return members.join(names, "class").select("doc_id", "class_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, that with the least doc_id (null ids last; of
    tied or repeated rows one), all columns, whatever their names.  Null and empty texts are
    copies of each other; texts of any length are compared whole; an empty table gives
    an empty one."""
    rows = _rows(docs)
    texts = rows.select("row", text_or_empty("whole.text").alias("text"))
    doc_id = F.col("whole.doc_id")
    kept = rows.select("row", doc_id.isNull().alias("none"), doc_id.alias("id")).join(classes(texts), "row").groupBy(
        "class"
    ).agg(F.min(F.struct("none", "id", "row")).alias("first")).select("first.row")
    return rows.join(kept.hint("merge"), "row", "left_semi").select("whole.*")
