"""Operator 12."""

import random
from collections import Counter
from itertools import permutations
from math import factorial

import duckdb
import pytest

from auditmart.llm import filter_audit as fa
from auditmart.llm import queries

import re


def brute(docs, labels):
    """The audit by applying every order to every document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, source in docs:
        t = text or ""
        words = [w for w in re.split("[ \t-\r]+", t) if w]
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            failed.add("C")
        if re.search("[#$%&*|]", t):
            failed.add("D")
        if d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in docs):
            failed.add("E")
        rows.append((d, source or "", failed))
    out = set()
    for part in {p for _, p, _ in rows}:
        mine = [(d, f) for d, p, f in rows if p == part]
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = mine
            gone = []
            for step, own in enumerate(order, 1):
                lost = [x for x in left if own in x[1]]
                steps.append((
                    part, "".join(order), step, own, len(left) - len(lost), len(lost),
                    sum(own in f for _, f in gone), sum(f == {own} for _, f in mine),
                    sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost),
                ))
                shapley[own] += len(lost)
                left, gone = [x for x in left if own not in x[1]], gone + lost
        out |= {(*s[:3], *s[4:], shapley[s[3]]) for s in steps}
    return out


def corpus():
    rnd = random.Random(4)
    words = ["ab", "Cd", "éa", "x", "longer", "THE", "a|b", "q&a"]
    docs = []
    for i in range(60):
        n = rnd.choice([0, 3, 150, 230, 400])
        text = rnd.choice([" ", "\t", " \x0b\n", "  "]).join(rnd.choices(words[: rnd.randint(1, 8)], k=n))
        if rnd.random() < 0.5:
            text += " " + " ".join(f"w{j}" for j in range(rnd.randint(0, 300)))
        docs.append((i, text, rnd.choice(["s", "t", None, ""])))
    docs += [(60 + i, rnd.choice(docs)[1], rnd.choice(["s", "t", "u"])) for i in range(40)]
    docs += [(3, docs[3][1], "s"), (3, docs[3][1], "t"), (None, docs[5][1], "s"), (None, docs[5][1], "s"), (200, None, None)]
    docs += [(7, docs[70][1], "s"), (300, "x " * 200_000, "u"), (301, "x " * 200_000, "u")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 100, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    return docs, labels


def test_audit_equals_brute_force(spark, docs_of):
    docs, labels = corpus()
    table = docs_of(docs).withColumnRenamed("row", "part")  # a clashing extra column
    label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.audit(fa.mask_counts(table, label_table))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) == 120 * 5 * len({s or "" for _, _, s in docs})
    assert set(rows) == brute(docs, labels)
    assert fa.audit(fa.mask_counts(table.limit(0), label_table)).count() == 0
    unlabelled = fa.audit(fa.mask_counts(table, label_table.limit(0))).collect()
    assert not any(r["good_lost"] or r["toxic_lost"] for r in unlabelled)


def test_lattice_counts_paths():
    for n in (1, 3, 5):
        edges = fa.lattice(n)
        assert len(edges) == n * 2 ** (n - 1)
        for s, f, orders in edges:
            k = s.bit_count()
            assert orders == factorial(k) * factorial(n - k - 1)
    # the steps of all orders use each edge as often as its paths say
    used = Counter((s, f) for _, _, s, f in fa.order_steps("ABCD"))
    assert used == {(s, f): w for s, f, w in fa.lattice(4)}


def test_other_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 2, 0), ("p", 2, 1, 0, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): r for r in fa.audit(counts, "XY").collect()}
    assert (got["XY", 1]["removed"], got["XY", 2]["removed"], got["XY", 2]["redundant"]) == (2, 1, 2)
    assert (got["YX", 1]["removed"], got["YX", 2]["removed"], got["YX", 2]["kept"]) == (3, 0, 5)
    assert got["XY", 2]["shapley"] == 4 and got["XY", 1]["shapley"] == 2
    with pytest.raises(ValueError):
        fa.audit(counts, "ABCDEFGH")


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    got = queries.QUERIES["op12_filter_audit"](spark, sf)
    expected = con.execute(queries.ORACLE_SQL["op12_filter_audit"]).df()[got.columns]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.itertuples(index=False)))


def test_plan_has_no_python_and_no_product(spark, sf):
    plan = queries.QUERIES["op12_filter_audit"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
