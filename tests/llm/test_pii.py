"""Operator 11."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from auditmart.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def random_texts(n, seed):
    rnd = random.Random(seed)
    parts = ["a.b@c.de", "x@y", "@", ".", "1.2.3.4", "300.1.2.3.4", "1.2.3.4.5.6.7.8", "+1 (212) 555-0101", "+", " ", " ", "-", "--",
             "4539578763621486", "4539 5787 6362 1486", "0", "12", "é", "٣", "(", ")", "12345", "name", "%+-@-.-", "..", "a@b.c@d.e", "\n",
             "007.08.9.0255", "2718"]
    return ["".join(rnd.choices(parts, k=rnd.randint(1, 12))) for _ in range(n)]


def test_base_spans_equal_the_rules():
    for text in random_texts(20_000, 1):
        assert pii.base_spans(text) == brute_base(text), text


def test_long_texts_take_linear_time():
    begin = time.process_time()
    for text in ("a" * 2_000_000, "1" * 1_000_000, "1." * 500_000, "a@" * 300_000, "+1" + " " * 1_000_000, "1 " * 300_000, "((" * 500_000 + "1", "+1 " * 300_000):
        base = pii.base_spans(text)
        assert len(list(pii.candidates(text, base))) <= 8 * len(text)
    assert time.process_time() - begin < 60


def test_taken_keeps_disjoint_stretches():
    rnd = random.Random(3)
    for _ in range(300):
        taken, cells = pii.Taken(), set()
        for _ in range(30):
            s = rnd.randint(0, 60)
            e = s + rnd.randint(1, 6)
            assert taken.free(s, e) == cells.isdisjoint(range(s, e))
            if rnd.random() < 0.6:
                taken.add(s, e)
                cells |= set(range(s, e))


def brute(docs):
    """The whole method on dictionaries."""
    texts = [(d, t or "") for d, t in docs]
    words = Counter(w for _, t in texts for w in re.split("[ \t-\r]+", t) if w)
    members, seeds = defaultdict(Counter), set()
    open_values = set()
    for _, t in texts:
        base = brute_base(t)
        for (s, k, e), seed in [(b, True) for b in base] + [(c, False) for c in pii.candidates(t, base)]:
            v = (k, pii.value_of(t[s:e], k))
            (seeds if seed else open_values).add(v)
            for p in pii.patterns(t, s, k, e):
                members[(k, *p)][v] += 1
    known, belief = set(seeds), {}
    for _ in range(pii.ROUNDS):
        trust = {}
        for p, values in members.items():
            mine = [v for v in values if v in known]
            if len(mine) >= pii.MIN_SUPPORT:
                if p[1] in "LR":
                    trust[p] = min(1.0, sum(values[v] for v in mine) / (words.get(p[2], len(values)) + 1))
                else:
                    trust[p] = len(mine) / (len(values) + 1)
        best = defaultdict(dict)
        for p, values in members.items():
            for v in values:
                if v not in seeds:
                    best[v][p[1]] = max(best[v].get(p[1], 0.0), trust.get(p, 0.0))
        belief = {}
        for v, found in best.items():
            doubt = 1.0
            for t in "SHGLR":
                doubt *= 1.0 - found.get(t, 0.0)
            belief[v] = 1.0 - doubt
        known = seeds | {v for v, b in belief.items() if b >= pii.ACCEPT}
    out = []
    for d, t in texts:
        base = brute_base(t)
        found = []
        for s, k, e in pii.candidates(t, base):
            v = (k, pii.value_of(t[s:e], k))
            if v in known:
                found.append((1.0 if v in seeds else belief[v], s, k, e))
        spans, used = list(base), set()
        for s, _, e in base:
            used |= set(range(s, e))
        for b, s, k, e in sorted(found, key=lambda f: (-f[0], -(f[3] - f[1]), f[1], f[2])):
            if used.isdisjoint(range(s, e)):
                used |= set(range(s, e))
                spans.append((s, k, e))

        def listed(x):
            return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(x))

        counts = [sum(k == i for _, k, _ in base) for i in range(4)]
        out.append((d, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base)))
    return out


def card(rnd):
    while True:
        d = "".join(rnd.choices("0123456789", k=16))
        if luhn(d):
            return d


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    word = lambda: rnd.choice("the of and with river stone paper garden window table".split())
    docs = []
    for i in range(120):
        phone = f"+1 ({rnd.randint(100, 999)}) 555-{rnd.randint(0, 9999):04d}"
        ids = [phone, card(rnd), f"{word()}.{i}@mail{i % 5}.example.com", ".".join(str(rnd.randint(0, 255)) for _ in range(4))]
        for x in ids:
            docs.append(f"{word()} {word()} {'Tel: ' if x is phone and i < 80 else ''}{x} {word()} {word()}")
    planted = []
    # a phone number that runs into a card number, two cards in a row, a phone before an address
    planted += [f"and +1 (269) 555-3{i:03d} {card(rnd)} of" for i in range(5)]
    planted += [f"the {card(rnd)} {card(rnd)} of", "with +1 (843) 555-7672 170.106.47.218 and"]
    # a shape no rule knows after a telling word
    planted += [f"river Tel: 212-555-01{i:02d} table" for i in range(5)]
    clean = ["order 20240131 of the table", "version 2.0.1 of 12 345 6789", "the 1234567890 and", "4539578763621487 garden", "see a@b or c", "x 1.2.3 y"]
    texts = docs + planted + clean
    rnd.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)], set(planted), set(clean)


def test_method_equals_brute_force_and_finds_planted(spark, docs_of, corpus):
    rows, planted, clean = corpus
    extra = [(9001, None), (9002, ""), (None, "Tel: 212-555-0177 x"), (3, rows[3][1]), (3, rows[3][1]), (9003, "word " * 50_000 + "a@b.cd")]
    extra += [(9100 + i, t) for i, t in enumerate(random_texts(300, 2))]
    docs = rows + extra
    got = pii.personal_data(docs_of(docs))
    result = got.collect()
    assert Counter(tuple(r)[:8] for r in result) == Counter(brute(docs))
    by_id = {r["doc_id"]: r for r in result}
    for i, t in rows:
        r = by_id[i]
        listed = [x.split(":") for x in r["spans"].split(",") if x]
        if t in planted:
            covered = set().union(*(range(int(s), int(e)) for _, s, e in listed))
            assert all(j in covered for j, c in enumerate(t) if c.isdigit()), t
        if t in clean:
            assert not listed, t
        assert {tuple(x) for x in listed} >= {(pii.KINDS[k], str(s), str(e)) for s, k, e in brute_base(t)}
    assert by_id[9001]["spans"] == "" and by_id[9001]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[None]["n_found"] == 1
    assert [(f["kind"], f["start"]) for f in by_id[None]["found"]] == [("phone", 5)]
    assert pii.personal_data(docs_of(docs).limit(0)).count() == 0


def test_hot_patterns_are_joined_apart(spark, docs_of, corpus, monkeypatch):
    rows = corpus[0]
    expected = Counter(tuple(r)[:8] for r in pii.personal_data(docs_of(rows)).collect())
    for share in (0.0, 2.0):  # every pattern heavy, none heavy
        monkeypatch.setattr(pii, "HOT_SHARE", share)
        assert Counter(tuple(r)[:8] for r in pii.personal_data(docs_of(rows)).collect()) == expected


def test_query_equals_brute_force(spark, sf):
    from auditmart.llm import queries

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_contextual_pii"](spark, sf)
    assert Counter(tuple(r)[:8] for r in got.collect()) == Counter(brute(docs))
