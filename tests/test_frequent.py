"""Heavy items by the sketch: none is missed, weak buckets are counted exactly, and the
signup-time report scans the log once before its joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditmart.operators.frequent import heavy_items, unlisted_bound
from auditmart.plans import signup_time
from auditmart.queries import audit
from auditmart.sources import scratch_path, write_table
from conftest import SF
from test_plans import plan


def skewed(spark):
    """Item i has about 200000 / i rows (Zipf), the left side twice the right."""
    return spark.range(0, 300_000, 1, 8).selectExpr(
        "CAST(pow(100000, rand(3)) AS LONG) AS k", "id % 3 < 2 AS is_left", "IF(id % 50 = 0, NULL, id) AS x"
    )


@pytest.mark.parametrize("items,limit", [(65_536, 1e6), (256, 1e7), (16, 4e5), (16, 1e12)])
def test_no_heavy_item_is_missed(spark, items, limit):
    path = scratch_path(spark, "test/zipf")
    write_table(skewed(spark), path)
    rows = spark.read.parquet(path)
    sides = {"l": F.col("is_left"), "r": ~F.col("is_left")}

    def heavy(n):
        return n["l"].cast("double") * n["r"].cast("double") > limit

    true = {
        r["k"]
        for r in rows.groupBy("k").agg(F.count(F.when(F.col("is_left"), 1)).alias("l"), F.count(F.when(~F.col("is_left"), 1)).alias("r")).collect()
        if r["l"] * r["r"] > limit
    }
    got = [r["k"] for r in heavy_items(rows, "k", sides, heavy, items=items, buckets=5).collect()]
    assert len(got) == len(set(got)) and true <= set(got)
    if items == 65_536:
        assert set(got) == true  # nothing was left out of the sketch, so counts are exact
    else:
        assert len(got) <= 5 * len(true) + 5


def test_unlisted_items_stay_below_the_bound(spark):
    """What Spark's sketch does not list has fewer rows than the bound says."""
    rows = skewed(spark).select("k")
    for items in (16, 256, 4096):
        listed = {r[0]["item"] for r in rows.agg(F.expr(f"approx_top_k_accumulate(k, {items})").alias("s")).select(
            F.explode(F.expr(f"approx_top_k_estimate(s, {items})"))).collect()}
        bound = spark.range(1).select(unlisted_bound(F.lit(300_000), items)).first()[0]
        missed = [r["count"] for r in rows.groupBy("k").count().collect() if r["k"] not in listed]
        assert max(missed) <= bound


def test_nulls_and_empty_rows(spark):
    rows = spark.createDataFrame([(None, 1)] * 50 + [(3, 1)] * 4, "k long, v int")
    sides = {"all": F.col("v") == 1}
    got = heavy_items(rows, "k", sides, lambda n: n["all"] > 3)
    assert [r["k"] for r in got.collect()] == [3]
    assert heavy_items(rows.limit(0), "k", sides, lambda n: n["all"] > 3).count() == 0


def test_pair_counts_do_not_overflow(spark):
    """Bounds multiply as doubles."""
    one = spark.createDataFrame([(1,)], "k long")
    many = {n: F.lit(True) for n in ("a", "b")}
    big = heavy_items(one, "k", many, lambda n: (n["a"] * 4e9).cast("double") * (n["b"] * 4e9).cast("double") > 1e18)
    assert big.count() == 1


def test_one_scan_before_the_join(spark):
    """Building R3 runs the sketch and, without candidates, nothing more; its plan then
    reads each operation once and holds no checkpointed table."""
    log = audit(spark, SF["0.01"])
    sc = spark.sparkContext
    sc.setJobGroup("r3", "jobs that building R3 runs")
    try:
        report = signup_time.report(log)
        stages = [
            sc.statusTracker().getJobInfo(j).stageIds for j in sc.statusTracker().getJobIdsForGroup("r3")
        ]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # adaptive execution runs the sketch's stages as jobs; two looks whether it found any
    assert len(stages) <= 5
    p = plan(report)
    assert p.count("events.parquet") == 3 and "ExistingRDD" not in p
    joined = signup_time.report(log, float("inf"))
    assert Counter(map(tuple, report.collect())) == Counter(map(tuple, joined.collect()))
