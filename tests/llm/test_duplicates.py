"""Operators 4, 6, 8 and 10 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from auditmart.llm import bagminhash, common, fingerprint, passages, shared_keys, suffix_dedup


def words(rnd, n, size=3000):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def mutated(rnd, w, n):
    w = list(w)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
    return w


def tokens_of(text):
    return re.findall(r"[0-9a-z_\x80-\U0010ffff]+", (text or "").lower())


# --- shared helpers -----------------------------------------------------------------------


def test_shingles_and_spans():
    w = common.Words(["A b c d e f", "", "x y", "a B  c,d e"])
    assert np.diff(w.first).tolist() == [6, 0, 2, 5]
    s, first = common.shingles(w, 5)
    assert np.diff(first).tolist() == [2, 0, 1, 1]
    assert s[0] == s[first[3]] and len(set(s.tolist())) == 3


def test_components_against_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["label"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for a, b in edges for x in (a, b) if a != b}


# --- near duplicates -----------------------------------------------------------------------


def test_signatures_are_unbiased_for_weights():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(30):
        e = rng.integers(0, 2**63, 60, dtype=np.uint64)
        w = rng.integers(1, 9, 60)
        v = np.maximum(0, w + rng.integers(-3, 4, 60))
        keep = np.concatenate([w, v]) > 0
        s = bagminhash.signatures(
            np.repeat([0, 1], 60)[keep], np.concatenate([e, e])[keep], np.concatenate([w, v])[keep].astype(float), 2, 400
        )
        off.append((s[0] == s[1]).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum())
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.04


def brute_classes(rows):
    """Class of every text by exact weighted Jaccard of five-word shingles."""
    texts = sorted({t or "" for _, t in rows})
    bags = []
    for t in texts:
        w = tokens_of(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []))
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both and both >= 0.8 * sum((bags[i] | bags[j]).values()) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    ids = defaultdict(list)
    for d, t in rows:
        ids[label[texts.index(t or "")]].append(d)
    return {(d, t): min((x for x in ids[label[texts.index(t or "")]] if x is not None), default=None) for d, t in rows}


def test_near_duplicates_against_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", 7)  # several blocks per bucket
    rnd = random.Random(2)
    base = words(rnd, 200)
    rows = [(i, " ".join(mutated(rnd, base, rnd.choice([1, 2, 4, 6, 9])))) for i in range(60)]
    rows += [(100 + i, " ".join(words(rnd, rnd.choice([1, 3, 30])))) for i in range(20)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[3][1].upper()), (203, None), (204, ""), (None, rows[65][1]),
             (205, "again " * 30_000), (205, "again " * 30_000)]
    table = docs_of(rows)
    want = brute_classes(rows)
    got = bagminhash.near_duplicates(table).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter((d, want[d, t]) for d, t in rows)
    kept = bagminhash.drop_near_duplicates(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    assert bagminhash.near_duplicates(table.limit(0)).count() == 0


def test_texts_are_hashed_in_parts_and_moved_by_shuffles(spark, docs_of):
    texts = ["x" * 700_000, "", "y" * 700_000, "z" * 5_000_000, "a b", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array([t or "" for t in texts])], ["row", "text"])
    parts = list(bagminhash._parts([batch, batch.slice(0, 0)], (1,)))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(6))
    assert all(sum(len(t) for t in p.column(1).to_pylist()[:-1]) <= bagminhash.PART_BYTES for p in parts) and len(parts) > 2
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    whole = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "row long, text string")
    found = bagminhash.verify(pairs, whole)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


# --- suffix dedup -----------------------------------------------------------------------------


def brute_repeats(rows, length=50):
    """(n_bytes, n_removed, n_spans, kept_sha256) per row, as a multiset."""
    first = {}
    data = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            first[b[i : i + length]] = min(d, first.get(b[i : i + length], d))
    out = Counter()
    for (d, t), (rank, b) in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < rank:
                gone[i : i + length] = True
        edges = np.diff(gone.astype(int), prepend=0)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[d, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("lane_bytes", [600, 1 << 22])
def test_suffix_dedup_against_brute_force(spark, docs_of, monkeypatch, lane_bytes):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(shared_keys.lanes, "__defaults__", (lane_bytes,))
    rnd = random.Random(lane_bytes)
    shared = [" ".join(words(rnd, n)) for n in (12, 20, 40)]
    rows = []
    for i in range(40):
        parts = [" ".join(words(rnd, rnd.randrange(3, 20)))]
        if i % 2:
            parts.insert(rnd.randrange(2), rnd.choice(shared)[rnd.randrange(20):])
        rows.append((rnd.randrange(1000), " ".join(parts)))
    rows += [(5, rows[0][1]), (6, rows[0][1][:49]), (7, rows[0][1][:50]), (8, None), (9, ""), (10, "é" * 120), (11, "é" * 90),
             (12, "ab" * 400), (13, "ba" * 100), (14, "!" * 70), (15, "!" * 500), (None, rows[1][1]), (None, rows[1][1]),
             (16, shared[2]), (16, shared[2])]
    # one id with more rows than a lane holds, between others with the same texts
    rows += [(2000 + d, rnd.choice(shared) + f" {i}") for d, n in ((0, 3), (1, 25), (2, 3)) for i in range(n)]
    table = docs_of(rows).repartition(3)
    got = suffix_dedup.remove_repeats(table).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)
    assert suffix_dedup.remove_repeats(table.limit(0)).count() == 0


def test_suffix_dedup_of_a_long_text(spark, docs_of):
    rnd = random.Random(31)
    letters = "".join(rnd.choice("abcdefgh ") for _ in range(1_200_000))
    tail = "".join(rnd.choice("abcdefgh ") for _ in range(70_000))
    rows = [(3, letters + tail), (7, letters[500_000:500_049] + "#" + letters[700_000:700_300] + tail), (1, tail[60_000:])]
    got = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)


def test_suffix_dedup_moves_lanes_once_and_clears_up(spark, docs_of):
    before = {t.name for t in spark.catalog.listTables()}
    texts = [(i, f"{i} " + "the same passage in every document, over fifty bytes long") for i in range(50)]
    assert suffix_dedup.remove_repeats(docs_of(texts)).where("n_removed > 0").count() == 49
    assert {t.name for t in spark.catalog.listTables()} == before
    laid = shared_keys.lanes(docs_of(texts), buckets=4)
    plan = laid.join(spark.createDataFrame([(1, b"x")], "lane long, reply binary").hint("merge"), "lane", "left")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(lane") == 1  # the replies only
    common.discard(laid)


def test_equal_ids_fill_lanes_of_one_place(spark, docs_of):
    rows = [(1, "a" * 90), (2, "b" * 90), *((5, f"{i:090d}") for i in range(30)), (6, "c" * 90), (None, "d" * 400), (None, "e" * 400)]
    laid = shared_keys.lanes(docs_of(rows).repartition(3), 500).collect()
    assert Counter(d for r in laid for d in r["ids"]) == Counter(d for d, _ in rows)
    for r in laid:
        assert len(r["data"]) == sum(r["sizes"]) <= 500
    places = {}
    for r in laid:
        for d in r["ids"]:
            places.setdefault(d, set()).add(r["ord"])
    assert all(len(p) == 1 for p in places.values())
    assert len([r for r in laid if set(r["ids"]) == {5}]) >= 6
    by_id = [places[d].pop() for d in (1, 2, 5, 6, None)]
    assert by_id == sorted(by_id)


# --- fingerprints -----------------------------------------------------------------------------


def test_edited_and_next_documents(spark, docs_of):
    rnd = random.Random(7)
    rows = [(i * 3 % 97, " ".join(words(rnd, rnd.randrange(1, 60)))) for i in range(97)]
    rows += [(500, ""), (501, None), (502, "ab"), (503, "🙂é" * 40), (504, rows[0][1]), (505, "long " * 20_000)]
    got = {r["doc_id"]: r for r in fingerprint.compare_edited(docs_of(rows).repartition(4)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (d, t), (_, f) in zip(order, order[1:] + order[:1]):
        t, f = t or "", f or ""
        k = len(t) // 3
        changed = t[: len(t) - k] + f[:k]
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
        if changed == t:
            assert got[d]["near_edited"] == 1.0
    assert got[504]["fingerprint"] == got[rows[0][0]]["fingerprint"]
    assert got[500]["fingerprint"] == got[501]["fingerprint"]
    long = [d for d, t in rows if t and len(t) > 60 and d < 500]
    assert np.mean([got[d]["near_edited"] for d in long]) > 0.5 > 0.1 > np.mean([got[d]["near_next"] for d in long])
    one = fingerprint.compare_edited(docs_of([(1, "only one")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprint.compare_edited(docs_of(rows).limit(0)).count() == 0
    tied = fingerprint.compare_edited(docs_of([(1, "a b c"), (1, "a b c"), (None, "d"), (None, "e")])).collect()
    assert len(tied) == 4


def test_edit_distance_shows_in_the_fingerprint():
    rnd = random.Random(8)
    text = " ".join(words(rnd, 400))
    inserted = text[:1000] + "xyz" + text[1000:]
    other = " ".join(words(rnd, 400))
    a, b, c = fingerprint.fingerprints([text, inserted, other])
    assert (a == b).mean() > 0.8 and (a == c).mean() < 0.1
    assert (fingerprint.fingerprints([text])[0] == a).all()  # whatever the batch


def test_near_pairs(spark, docs_of):
    rnd = random.Random(6)
    base = " ".join(words(rnd, 300))
    rows = [(1, base), (2, base + " tail"), (3, base), (4, " ".join(words(rnd, 300))), (5, "")]
    prints = fingerprint.fingerprint(docs_of(rows))
    assert {(r["a"], r["b"]) for r in fingerprint.near_pairs(prints).collect()} == {(1, 2)}


# --- passages -----------------------------------------------------------------------------------


def test_compact_windows_against_brute_force():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 2**63, 300, dtype=np.uint64)
    begin = np.array([0, 120, 125, 300])
    c, left, right = passages.tree(h, begin, 20)
    want = set()
    for a, b in zip(begin, begin[1:]):
        for i in range(a, b):
            lo, hi = i, i
            while lo > a and h[lo - 1] > h[i]:
                lo -= 1
            while hi + 1 < b and h[hi + 1] > h[i]:
                hi += 1
            if hi - lo + 1 >= 20:
                want.add((i, lo, hi))
    assert set(zip(c.tolist(), left.tolist(), right.tolist())) == want


def test_repeated_passages_against_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(shared_keys.lanes, "__defaults__", (3000,))
    monkeypatch.setattr(passages, "BUCKET_BYTES", 5000)
    rnd = random.Random(12)
    shared = [words(rnd, n) for n in (55, 60, 90)]
    rows = []
    for i in range(40):
        w = words(rnd, 80)
        if i % 3 == 0:
            w[30:30] = shared[i % 9 // 3]
        if i % 3 == 1:
            w[10:10] = shared[i % 9 // 3][:35]  # too short to be a passage
        rows.append((i, " ".join(w)))
    edited = mutated(rnd, shared[2], 1)
    rows += [(60, " ".join(words(rnd, 20) + edited)), (61, None), (62, ""), (63, rows[1][1]), (64, rows[1][1]),
             (None, " ".join(shared[0])), (65, "same line of words " * 2000), (66, "same line of words " * 30)]
    table = docs_of(rows).repartition(3)
    found = passages.repeated_passages(table).collect()
    windows, cover = defaultdict(set), defaultdict(list)
    for n, (d, t) in enumerate(rows):
        w = tokens_of(t)
        for k in range(len(w) - 49):
            windows[tuple(w[k : k + 50])].add((n, d))
    for r in found:
        assert r["n_words"] >= 50
        cover[r["doc_id"]].append((r["start_word"], r["start_word"] + r["n_words"]))
    for n, (d, t) in enumerate(rows):
        w = tokens_of(t)
        for k in range(len(w) - 49):
            if len(windows[tuple(w[k : k + 50])]) > 1:
                assert any(a <= k and k + 50 <= b for a, b in cover[d]), (d, k)
    repeated = {d for group in windows.values() if len(group) > 1 for _, d in group}
    assert set(cover) == repeated | {60}  # the edited passage, and no clean document
    classes = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] in (0, 9, 18, 27)}
    assert len(set(classes.values())) == 1
    assert passages.repeated_passages(table.limit(0)).count() == 0


def test_passages_with_an_edit_at_any_word():
    rnd = random.Random(31)

    def tokens(w):
        return common.shingles(common.Words([" ".join(w)]), passages.SHINGLE)[0]

    def similar(x, y):  # some pair of runs of the least width, or the whole passage, by brute force
        n = len(x) - 45
        sets = [(set(x[i : i + 46].tolist()), set(y[i : i + 46].tolist())) for i in range(n)] + [(set(x.tolist()), set(y.tolist()))]
        return any(len(p & q) >= 0.8 * len(p | q) for p, q in sets)

    for size in (50, 55, 60, 65, 70, 75):
        passage = words(rnd, size)
        for at in range(size):
            other = passage[:at] + ["changed"] + passage[at + 1 :]
            before = [words(rnd, 30) for _ in range(2)]
            x, y = ([*w, *p, *words(rnd, 30)] for w, p in zip(before, (passage, other)))
            assert similar(tokens(passage), tokens(other))
            # a least token amid the longer half
            seed = 30 + (at + size - 4) // 2 if at < size // 2 else 30 + max(0, at - 4) // 2
            got = list(passages.aligned(tokens(x), tokens(y), [seed]))
            assert got, (size, at)
            for s, n, p, m in got:
                assert min(n, m) >= 46 and similar(tokens(x)[p : p + m], tokens(y)[s : s + n])
    # 40 shared words are too few, wherever the span is taken
    short = words(rnd, 40)
    x, y = (tokens(words(rnd, 30) + short + words(rnd, 30)) for _ in range(2))
    assert not list(passages.aligned(x, y, [45]))


@pytest.mark.parametrize("block", [1000, 3])
def test_copies_behind_partial_ones_are_linked(spark, docs_of, monkeypatch, block):
    """Copies whose every window an earlier document has too, which is no partner itself."""
    monkeypatch.setattr(passages, "BLOCK", block)
    rnd = random.Random(41)
    rows, pairs = [], []
    for case in range(25):
        passage, d = words(rnd, 56), 10 * case
        parts = [passage[:44], passage[-44:], passage, passage]
        rows += [(d + k, " ".join(words(rnd, 60) + p + words(rnd, 60))) for k, p in enumerate(parts)]
        pairs.append((d + 2, d + 3))
    line = " ".join(words(rnd, 7))
    rows += [(900 + k, " ".join(words(rnd, 50)) + f" {line}" * n) for k, n in enumerate((4, 30, 40, 3, 50))]
    found = passages.repeated_passages(docs_of(rows)).collect()
    classes = defaultdict(set)
    for r in found:
        classes[r["doc_id"]].add(r["class_id"])
    assert all(classes[a] & classes[b] for a, b in pairs)
    assert not any(d in classes for a, b in pairs for d in (a - 2, a - 1))
    assert classes[901] & classes[902] & classes[904]


def test_bound_on_common_tokens_never_drops_a_passage():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = 2 * passages.AROUND + 1
        x = rng.integers(1, rng.choice([4, 30, 10**6]), n)
        y = np.where(rng.random(n) < rng.choice([0.02, 0.1, 0.3]), rng.integers(1, 10**6, n), x)
        _, ids = np.unique(np.concatenate([[0], x, y]), return_inverse=True)
        a, b = ids[1 : n + 1], ids[n + 1 :]
        last = passages._last(np.stack([a, b]))
        aliens = [passages._fewest_distinct(~np.isin(p, q), k) for p, q, k in ((a, b, last[0]), (b, a, last[1]))]
        spare = len(np.intersect1d(a, b)) * 0.25 + 1e-9
        if passages.numbered(a, b, [passages.AROUND], np.zeros(ids.max() + 1, bool)):
            assert sum(aliens) <= spare


def test_members_of_many_keys_are_compared_at_once(monkeypatch):
    """The links of all keys of a task join what brute force over every pair joins, and few
    pairs without a passage reach its verification."""
    rng, n, size = np.random.default_rng(11), passages.AROUND, 2 * passages.AROUND + 1
    rows = []
    for key in range(6):
        base = rng.integers(1, 2**63, size, dtype=np.uint64)
        for doc in range(40):
            x = base.copy()
            wide = (20, 30, 60)[doc % 3]  # of the tokens about the middle, what all members have
            other = np.abs(np.arange(size) - n) > wide
            other[n + rng.integers(16, 30) :][: doc % 5] = True
            x[other] = rng.integers(1, 2**63, other.sum(), dtype=np.uint64)
            if key == 5:
                x = np.tile(x[n - 8 : n + 9], 8)[:size]  # goes round
            if doc % 7 == 0:
                x[: rng.integers(0, 40)] = 0  # before the text
            rows.append((key, 100 * key + doc, 0, doc, doc % 4 > 0, x))
    t = pa.table({
        "key": [r[0] for r in rows], "doc": [r[1] for r in rows], "block": [0] * len(rows), "chain": [0] * len(rows),
        "c": [r[3] for r in rows], "open": [r[4] for r in rows], "tokens": [r[5].tobytes() for r in rows],
        "lo": [0] * len(rows), "hi": [0] * len(rows),
    }).take(rng.permutation(len(rows)))
    verify, calls = passages.numbered, []
    monkeypatch.setattr(passages, "numbered", lambda *x: calls.append(verify(*x)) or calls[-1])
    got = {(r["x"], r["y"]) for r in passages._compared(t).to_pylist()}
    met, linked = len(calls), sum(map(bool, calls))

    def classes(links):
        parent = {r[1]: r[1] if r[4] else -1 - r[0] for r in rows}

        def find(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for x, y in links:
            parent[find(x)] = find(y)
        groups = defaultdict(set)
        for r in rows:
            groups[find(r[1])].add(r[1])
        return set(map(frozenset, groups.values()))

    want = set()
    for i, (k, x, _, _, _, a) in enumerate(rows):
        for k2, y, _, _, _, b in rows[i + 1 :]:
            if k2 == k:
                middle = int((b[:n] > 0).sum())
                if any(p <= int((a[:n] > 0).sum()) < p + m for _, _, p, m in passages.aligned(a[a > 0], b[b > 0], [middle])):
                    want.add((x, y))
    assert got and classes(got) == classes(want)
    assert linked == len(got) and met < 1.5 * len(got) + 20


def test_span_search_of_a_pair_skips_marks_that_cannot_hold_a_passage(monkeypatch):
    """Text whose tokens all stand elsewhere in the other, never together."""
    rng = np.random.default_rng(12)
    a = rng.permutation(np.arange(1, 6001)).astype(np.uint64)
    b = np.concatenate([np.concatenate([part[:16], rng.permutation(a)[:30]]) for part in np.split(a[:4600], 100)])
    searched, longest = [], passages.longest
    monkeypatch.setattr(passages, "longest", lambda *x: searched.append(1) or longest(*x))
    assert not passages.aligned(a, b, list(range(3, 4600, 46)))
    assert len(searched) == 0
