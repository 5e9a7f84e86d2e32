"""R2 over the bucketed log: same rows, and no exchange between a scan of the bucketed
table and the first aggregate or join above it."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditmart.plans import colocated, waitlist
from auditmart.queries import audit, states
from auditmart.sources import scratch_path
from conftest import SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def skewed(spark):
    """One actor with a third of the rows."""
    actor = F.col("created_by_user_id")
    return audit(spark, SF["0.01"]).withColumn("created_by_user_id", F.when(actor % 3 == 0, F.lit(1)).otherwise(actor))


def stored(spark, log_rows, name, hot_rows):
    log = colocated.BucketedLog(f"auditmart_test_{name}", scratch_path(spark, f"test/{name}_rest"))
    colocated.write_log(log_rows, log, scratch_path(spark, f"test/{name}"), 8, hot_rows)
    return log


def ancestors(plan):
    """For every file scan of an executed plan's text, the operators above it, nearest
    first."""
    lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plan.splitlines() if x.strip()]
    for i, (depth, text) in enumerate(lines):
        if "FileScan" in text:
            above = []
            for d, t in reversed(lines[:i]):
                if d < depth:
                    above.append(t.lstrip(" :+-"))
                    depth = d
            yield text, above


@pytest.mark.parametrize("hot_rows", [10**6, 1000])
def test_report_equals_the_plain_plan(spark, hot_rows):
    rows = skewed(spark)
    log = stored(spark, rows, f"log_{hot_rows}", hot_rows)
    cold, rest = colocated.read_log(spark, log)
    assert bag(cold.unionByName(rest)) == bag(rows)
    in_rest = {r[0] for r in rest.select("created_by_user_id").distinct().collect()}
    assert in_rest == ({None, 1} if hot_rows == 1000 else {None})
    got = colocated.waitlist_report(spark, log, states(spark, SF["0.01"]))
    assert bag(got) == bag(waitlist.report(rows, states(spark, SF["0.01"])))
    spark.sql(f"DROP TABLE {log.table}")


def test_no_exchange_on_the_log(spark):
    log = stored(spark, skewed(spark), "plan_log", 1000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        report = colocated.waitlist_report(spark, log, states(spark, SF["0.01"]))
        report.collect()
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = plan.split("== Initial Plan ==")[0]
    scans = [(text, above) for text, above in ancestors(plan) if "plan_log" in text and "plan_log_rest" not in text]
    assert len(scans) >= 3
    for text, above in scans:
        nearest = next(a for a in above if "Exchange" in a or "HashAggregate" in a or "SortMergeJoin" in a)
        assert "Exchange" not in nearest, (nearest, text)
    grouped = [above for _, above in scans if any("SortMergeJoin" in a for a in above)]
    assert grouped
    spark.sql(f"DROP TABLE {log.table}")
