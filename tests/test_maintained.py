"""Committed batches, maintained day counts and split points."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from auditmart.operators import audit as ops
from auditmart.plans import daily_cancel, maintained, program_audit
from auditmart.queries import audit, programs, slots
from auditmart.sources import ledger, range_predicates, read_table, scratch_path, split_points, write_table
from conftest import SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# --- ledger ------------------------------------------------------------------------------


def test_a_retried_batch_adds_nothing(spark):
    target = scratch_path(spark, "test/ledger")
    df = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS v")
    assert ledger.read_batches(spark, target) is None and ledger.committed(spark, target) == []
    assert ledger.write_batch(df, target, "job-7") is True
    assert ledger.write_batch(df, target, "job-7") is False
    assert ledger.write_batch(df.where("id > 2"), target, "08") is True
    assert ledger.committed(spark, target) == ["08", "job-7"]
    assert bag(ledger.read_batches(spark, target)) == bag(df) + bag(df.where("id > 2"))
    ids = bag(ledger.read_batches(spark, target, with_id=True).select("batch_id"))
    assert ids == Counter({("job-7",): 5, ("08",): 2})  # an id of digits stays text


def test_a_half_written_batch_is_not_seen_and_is_overwritten(spark):
    target = scratch_path(spark, "test/ledger_half")
    df = spark.range(4).toDF("id")
    ledger.write_batch(df, target, "a")
    write_table(spark.range(100).toDF("id"), f"{target}/batch_id=b")  # its job died before the commit
    assert ledger.read_batches(spark, target).count() == 4
    assert ledger.write_batch(df.limit(1), target, "b") is True
    assert ledger.read_batches(spark, target).count() == 5
    for bad in ("", "a/b", "x=y", "a b"):
        with pytest.raises(ValueError):
            ledger.write_batch(df, target, bad)
    with pytest.raises(ValueError):
        ledger.write_batch(df.withColumn("batch_id", F.lit("z")), target, "c")


def test_an_empty_batch_is_committed(spark):
    target = scratch_path(spark, "test/ledger_empty")
    df = spark.range(3).toDF("id")
    assert ledger.write_batch(df.limit(0), target, "none")
    assert ledger.read_batches(spark, target).count() == 0
    assert not ledger.write_batch(df, target, "none")


# --- maintained reports ----------------------------------------------------------------------


def test_three_loads_with_late_rows_equal_a_recomputation(spark):
    """Loads by hash, so every day gets late rows, one empty load and a retried one."""
    log = audit(spark, SF["0.01"])
    s, prg = slots(spark, SF["0.01"]), programs(spark, SF["0.01"])
    state = scratch_path(spark, "test/maintained")
    part = F.pmod(F.xxhash64(*log.columns), F.lit(3))
    seen = log.limit(0)
    for i in range(3):
        new = log.where(part == i)
        assert maintained.maintain(new, state, f"load{i}") is True
        assert maintained.maintain(new, state, f"load{i}") is False
        seen = seen.unionByName(new)
        assert bag(maintained.program_audit_report(spark, state, s, prg)) == bag(program_audit.report(seen, s, prg))
        assert bag(maintained.daily_cancel_report(spark, state)) == bag(daily_cancel.report(seen))
    maintained.maintain(log.limit(0), state, "nothing")
    assert maintained.loads(spark, state) == ["load0", "load1", "load2", "nothing"]
    merged = scratch_path(spark, "test/maintained_merged")
    maintained.compact(spark, state, merged, "until-load2")
    deltas, one = (ledger.read_batches(spark, p).count() for p in (state, merged))
    assert one < deltas
    again = ops.audit_base(log.where("audit_operation_id = 5").limit(7))
    for p in (state, merged):
        maintained.maintain(again, p, "load4")
    assert bag(maintained.daily_cancel_report(spark, merged)) == bag(maintained.daily_cancel_report(spark, state))
    with pytest.raises(ValueError):
        maintained.per_day(spark, scratch_path(spark, "test/maintained_none"))


def test_a_load_reads_only_its_own_rows(spark):
    """The report is planned over the deltas alone."""
    state = scratch_path(spark, "test/maintained_plan")
    maintained.maintain(audit(spark, SF["0.001"]), state, "a")
    files = maintained.daily_cancel_report(spark, state).inputFiles()
    assert files and all("maintained_plan" in f and "batch_id=a" in f for f in files)


def test_stored_chain_equals_the_reports(spark):
    from auditmart import jobs

    wh = jobs.pipeline_reports(spark, SF["0.001"], scratch_path(spark, "test/chain"))
    log = audit(spark, SF["0.001"])
    assert bag(read_table(spark, wh.daily_cancel_report)) == bag(daily_cancel.report(log))
    expected = program_audit.report(log, slots(spark, SF["0.001"]), programs(spark, SF["0.001"]))
    assert bag(read_table(spark, wh.program_audit_report)) == bag(expected)


# --- split points ----------------------------------------------------------------------------


def deal(spark, df, column, n):
    cuts = split_points(df, column, n)
    conditions = range_predicates(column, cuts)
    rows = df.select(*(F.expr(c).cast("int").alias(f"p{i}") for i, c in enumerate(conditions)))
    counts = rows.agg(*(F.sum(c).alias(c) for c in rows.columns)).first()
    met = rows.select(sum((F.coalesce(F.col(c), F.lit(0)) for c in rows.columns), F.lit(0)).alias("m"))
    assert met.where("m != 1").count() == 0  # every row in exactly one range, nulls too
    return cuts, [c or 0 for c in counts]


def test_ranges_of_a_skewed_key_are_equal(spark):
    """Most keys lie close together near 0, a few reach to 10^12: even steps would put all
    rows into one range."""
    df = spark.range(0, 100_000, 1, 8).selectExpr("CAST(pow(10, 12 * pow(rand(5), 8)) AS LONG) AS k")
    cuts, counts = deal(spark, df, "k", 16)
    top = df.agg(F.max("k")).first()[0]
    even = df.where(F.col("k") <= top / 16).count()
    assert even > 60_000
    distinct_limit = df.groupBy("k").count().agg(F.max("count")).first()[0]
    assert max(counts) <= 100_000 / 16 * 1.05 + distinct_limit


def test_ranges_with_ties_nulls_and_text(spark):
    hot = spark.range(0, 9000, 1, 4).selectExpr("IF(id % 3 = 0, NULL, IF(id % 3 = 1, 7, id)) AS k")
    cuts, counts = deal(spark, hot, "k", 8)
    assert cuts == sorted(set(cuts)) and sum(counts) == 9000
    assert deal(spark, hot.limit(0), "k", 8)[0] == [] and split_points(hot, "k", 1) == []
    assert range_predicates("k", []) == ["1 = 1"]
    assert range_predicates("n", ["a'b", "c"]) == ["n <= 'a''b' OR n IS NULL", "n > 'a''b' AND n <= 'c'", "n > 'c'"]
    rnd = random.Random(2)
    days = spark.createDataFrame([(rnd.randint(1, 28),) for _ in range(400)], "d int").selectExpr("make_date(2024, 2, d) AS d")
    cuts, counts = deal(spark, days, "d", 4)
    assert len(cuts) == 3 and max(counts) < 160
