"""Plan-shape tests: pushdown, pruning, single audit scan in R1, no Cartesian
product, no Python UDF on the report paths."""

import contextlib
import io
import re

import pytest

from auditmart.operators import audit as ops
from auditmart.plans import daily_cancel, program_audit
from auditmart.queries import QUERIES, slots
from auditmart.sources import read_table, scratch_path, write_table
from conftest import SF


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scans_of(p: str, table: str) -> int:
    return len(re.findall(rf"Scan parquet .*?\n.*?{table}\.parquet", p)) or len(
        re.findall(rf"Location: InMemoryFileIndex \[[^\]]*{table}\.parquet", p)
    )


@pytest.mark.parametrize("name", ["program_audit_report", "waitlist_report", "daily_cancel_report", "signup_time_report"])
def test_no_cartesian_no_python(spark, name):
    p = plan(QUERIES[name](spark, SF["0.001"]))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


@pytest.fixture(scope="module")
def stored_audit(spark):
    """The audit log as a stored warehouse table (its production layout), so
    ``audit_operation_id`` is a column the scan can filter on."""
    path = scratch_path(spark, "test/audit_dim")
    write_table(QUERIES["audit_base"](spark, SF["0.01"]), path, mode="overwrite")
    return ops.audit_base(read_table(spark, path))


@pytest.mark.parametrize("max_pairs", [float("inf"), -1])
def test_signup_plans_have_no_cartesian_or_python(spark, max_pairs):
    from auditmart.plans import signup_time
    from auditmart.queries import audit

    df = signup_time.report(audit(spark, SF["0.001"]), max_pairs)
    p = plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_daily_cancel_prunes_columns_of_driver_view(spark):
    p = plan(QUERIES["daily_cancel_report"](spark, SF["0.001"]))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "props" not in schema and "value" not in schema


def test_daily_cancel_pushes_operation_filter(stored_audit):
    p = plan(daily_cancel.report(stored_audit))
    assert "EqualTo(audit_operation_id,5)" in p
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "application_id" not in schema and "interview_event_id" not in schema


def test_program_audit_reads_the_log_once(spark, stored_audit):
    p = plan(QUERIES["program_audit_report"](spark, SF["0.001"]))
    assert p.count("events.parquet") == 1
    assert p.count("supplier.parquet") == 1
    p2 = plan(program_audit.report(stored_audit, slots(spark, SF["0.01"])))
    assert "In(audit_operation_id, [1,4,5])" in p2


def jobs_of(spark, build):
    """Jobs that building a DataFrame runs, and the DataFrame."""
    sc = spark.sparkContext
    group = "building"
    sc.setJobGroup(group, "count the jobs of building a report")
    try:
        df = build()
        return len(sc.statusTracker().getJobIdsForGroup(group)), df
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_waitlist_report_is_lazy(spark, stored_audit):
    from auditmart.plans import waitlist
    from auditmart.queries import states

    state_rows = states(spark, SF["0.001"])
    stored_audit.count()
    n, df = jobs_of(spark, lambda: waitlist.report(stored_audit, state_rows))
    assert n == 0
    p = plan(df)
    assert "EqualTo(audit_operation_id,1)" in p  # invitations: a pruned, pushed scan of their own


def test_withdraw_totals_shuffle_aggregates_only(spark):
    """With broadcast off, what meets the program table is counted first."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = QUERIES["total_withdraw"](spark, SF["0.001"])
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for scan in ("events.parquet", "nation.parquet"):
        assert scan in p
    below = [line for line in p.splitlines() if "Exchange" in line or "HashAggregate" in line or "FileScan" in line]
    # walking down to each scan, a partial aggregate stands between it and the exchange
    for i, line in enumerate(below):
        if "FileScan" in line:
            assert "HashAggregate" in below[i - 1]


def test_pipeline_pushes_the_operation_filter(spark):
    p = plan(QUERIES["warehouse_pipeline"](spark, SF["0.001"]))
    assert "In(audit_operation_id, [1,4,5])" in p


def test_partial_aggregation_before_shuffle(spark):
    p = plan(QUERIES["program_audit_report"](spark, SF["0.001"]))
    assert "partial_count" in p and "partial_sum" in p


def test_season_partitioned_audit_prunes_partitions(spark):
    """A warehouse audit table written partitioned by season: a report for one
    season reads only that season's files (PartitionFilters in the scan)."""
    path = scratch_path(spark, "test/audit_by_season")
    write_table(QUERIES["audit_base"](spark, SF["0.01"]), path, mode="overwrite", partition_by=["calendar_season_id"])
    stored = ops.audit_base(read_table(spark, path))
    one_season = daily_cancel.report(stored.where("calendar_season_id = 2"))
    p = plan(one_season)
    assert re.search(r"PartitionFilters: \[[^\]]*calendar_season_id[^\]]*= 2", p)
    expected = daily_cancel.report(QUERIES["audit_base"](spark, SF["0.01"])).where("calendar_season_id = 2")
    assert one_season.exceptAll(expected).count() == 0 and expected.exceptAll(one_season).count() == 0
