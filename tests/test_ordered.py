"""ordered_counts / with_range against brute force, with a hot key that spans
many range partitions, ties between probe and build, duplicates."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditmart.operators.ordered import ordered_counts, range_split, with_range


def _data(seed, n_probe=400, n_build=900, hot_share=0.4):
    rnd = random.Random(seed)

    def key():
        if rnd.random() < hot_share:
            return (1, 1)  # hot key
        return (rnd.randint(2, 12), rnd.randint(0, 3))

    probe = [(i, *key(), rnd.randint(0, 60)) for i in range(n_probe)]
    build = [(*key(), rnd.randint(0, 60)) for _ in range(n_build)]
    return probe, build


def _brute(probe, build):
    return {pid: sum(1 for (a, b, o) in build if (a, b) == (k1, k2) and o < po) for (pid, k1, k2, po) in probe}


@pytest.mark.parametrize("seed,parts", [(1, 7), (2, 13), (3, 1), (4, 29)])
def test_counts_match_brute_force(spark, seed, parts):
    probe, build = _data(seed)
    p = spark.createDataFrame(probe, "pid long, k1 long, k2 long, o long")
    b = spark.createDataFrame(build, "k1 long, k2 long, o long")
    out, ranked = ordered_counts(p, b, ["k1", "k2"], "o", count_col="n", rank_col="r", num_partitions=parts)
    got = {r["pid"]: r["n"] for r in out.collect()}
    assert got == _brute(probe, build)
    assert out.columns == ["pid", "k1", "k2", "o", "n"]
    # ranks: per key a permutation of 0..n-1 that respects the order
    rows = ranked.collect()
    per_key = {}
    for r in rows:
        per_key.setdefault((r["k1"], r["k2"]), []).append((r["r"], r["o"]))
    for key, lst in per_key.items():
        lst.sort()
        assert [x[0] for x in lst] == list(range(len(lst)))
        assert [x[1] for x in lst] == sorted(x[1] for x in lst)


def test_hot_key_spans_partitions(spark):
    probe, build = _data(5, hot_share=0.9)
    p = spark.createDataFrame(probe, "pid long, k1 long, k2 long, o long")
    b = spark.createDataFrame(build, "k1 long, k2 long, o long")
    out, _ = ordered_counts(p, b, ["k1", "k2"], "o", count_col="n", num_partitions=16)
    assert {r["pid"]: r["n"] for r in out.collect()} == _brute(probe, build)


def test_with_range(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 5), (4, 10000), (5, -2)], "id long, n long")
    out = with_range(df, "n", "i", chunk=64).groupBy("id").agg(F.count("*").alias("c"), F.min("i").alias("lo"), F.max("i").alias("hi"))
    got = {r["id"]: (r["c"], r["lo"], r["hi"]) for r in out.collect()}
    assert got == {2: (1, 0, 0), 3: (5, 0, 4), 4: (10000, 0, 9999)}
    assert Counter(r["i"] for r in with_range(df.where("id = 4"), "n", "i", chunk=64).collect()) == Counter(range(10000))


def test_range_split_bounds_every_chunk_under_a_hot_key(spark):
    """One key holds 90% of the rows; no range partition (hence no window
    group, no task) may hold much more than an even share."""
    probe, build = _data(6, n_probe=3000, n_build=9000, hot_share=0.9)
    p = spark.createDataFrame(probe, "pid long, k1 long, k2 long, o long")
    b = spark.createDataFrame(build, "k1 long, k2 long, o long")
    parts = 24
    ranged = range_split(p, b, ["k1", "k2"], "o", num_partitions=parts)
    sizes = {r["_om_part"]: r["n"] for r in ranged.groupBy("_om_part").agg(F.count("*").alias("n")).collect()}
    hot_rows = sum(1 for r in probe + build if (r[-3], r[-2]) == (1, 1))
    even = (len(probe) + len(build)) / parts
    assert hot_rows > 0.85 * (len(probe) + len(build))
    assert max(sizes.values()) < 3 * even  # the hot key is spread over many chunks
    hot_parts = ranged.where("k1 = 1 AND k2 = 1").select("_om_part").distinct().count()
    assert hot_parts >= parts // 2
