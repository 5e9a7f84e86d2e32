"""Property tests: report identities and invariance under row
order / partitioning."""

from collections import Counter

import pytest

from pyspark.sql import functions as F

from auditmart.operators.ordered import ordered_counts
from auditmart.plans import program_audit, signup_time, waitlist
from auditmart.queries import audit, slots, states
from conftest import SF


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_program_audit_identities(spark):
    r = program_audit.report(audit(spark, SF["0.01"]), slots(spark, SF["0.01"]))
    bad = r.where(
        (F.col("total_first_day_invites") + F.col("total_invites_after_first_day") != F.col("total_invites"))
        | (F.col("total_first_day_invites") > F.col("total_invites"))
        | (F.col("first_day_overage") != F.col("total_first_day_invites") - F.col("total_slots"))
        | (F.col("total_invites").isNotNull() & (F.col("total_invites") > 0) & F.col("first_invite_day").isNull())
    )
    assert bad.count() == 0


def test_waitlist_identities(spark):
    r = waitlist.report(audit(spark, SF["0.01"]), states(spark, SF["0.01"]))
    # application ids are unique in the state table here, so completed and
    # withdrawn are disjoint subsets of the waitlisted applications
    bad = r.where(
        (F.col("total_waitlisted_to_completed") + F.col("total_waitlisted_to_withdrawn") > F.col("total_waitlisted"))
        | (F.col("total_waitlisted_to_scheduled") > F.col("total_waitlisted"))
        | (F.col("total_waitlisted_to_completed") > F.col("total_waitlisted_to_canceled"))
    )
    assert bad.count() == 0


def test_reports_invariant_under_row_order_and_partitioning(spark):
    a = audit(spark, SF["0.01"])
    shuffled = a.withColumn("_r", F.rand(7)).repartition(37).sortWithinPartitions("_r").drop("_r")
    s = slots(spark, SF["0.01"])
    st = states(spark, SF["0.01"])
    assert bag(program_audit.report(a, s)) == bag(program_audit.report(shuffled, s))
    assert bag(waitlist.report(a, st)) == bag(waitlist.report(shuffled, st))
    assert bag(signup_time.report(a, float("inf"))) == bag(signup_time.report(shuffled, 20, num_partitions=23))


def hot_user_log(spark, all_tied=False):
    a = audit(spark, SF["0.01"])
    hot = F.col("user_id") % 3 == 0
    if all_tied:
        a = a.withColumn("created_date", F.when(hot, F.date_trunc("month", "created_date").cast("timestamp_ntz")).otherwise(F.col("created_date")))
    return a.withColumn("user_id", F.when(hot, F.lit(1)).otherwise(F.col("user_id")))


@pytest.mark.parametrize("all_tied", [False, True])
def test_hot_user_plans_agree(spark, all_tied):
    """One user holds a third of the log; only that user's keys pass the bound."""
    log = hot_user_log(spark, all_tied)
    split = signup_time.report(log, 10_000)
    joined = signup_time.report(log, float("inf"))
    assert split.exceptAll(joined).count() == 0 and joined.exceptAll(split).count() == 0
    assert all_tied or split.count() > 100_000


def test_only_hot_users_leave_the_join(spark):
    log = hot_user_log(spark)
    assert {r["user_id"] for r in signup_time.hot_users(log, 10_000).collect()} == {1}
    assert {r["user_id"] for r in signup_time.hot_users(log, 10_000, invitations=False).collect()} == {1}


def test_tied_rows_of_a_hot_user_become_one_weighted_row(spark):
    """20,000 equal schedules and waitlists meet as two rows, and the copies of
    their one output group are generated by several tasks."""
    n = 20_000
    schema = "program_id long, calendar_season_id long, user_id long, interview_event_id long, schedule_date timestamp_ntz"
    t = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    s = spark.range(n).selectExpr("1L AS program_id", "1L AS calendar_season_id", "7L AS user_id",
                                  "3L AS interview_event_id", f"{t} AS schedule_date")
    w = spark.range(n).selectExpr("7L AS user_id", "3L AS interview_event_id", "CAST(NULL AS TIMESTAMP_NTZ) AS waitlist_date")
    counted = signup_time._sw_ordered(s, w, 8)
    rows = counted.collect()
    assert len(rows) == 1 and rows[0]["n_waitlists"] == n * n
    few = counted.withColumn("n_waitlists", F.lit(60_000).cast("long"))
    copies = signup_time._copies(few, F.col("n_waitlists"))
    per_task = [r["count"] for r in copies.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 60_000 and len(per_task) > 1


def test_ordered_counts_empty_sides(spark):
    p = spark.createDataFrame([(1, 1, 5), (2, 1, 7)], "pid long, k long, o long")
    empty = spark.createDataFrame([], "k long, o long")
    out, ranked = ordered_counts(p, empty, ["k"], "o", count_col="n", rank_col="r", num_partitions=4)
    assert sorted((r["pid"], r["n"]) for r in out.collect()) == [(1, 0), (2, 0)]
    assert ranked.count() == 0
    b = spark.createDataFrame([(1, 1), (1, 9)], "k long, o long")
    out2, _ = ordered_counts(p.limit(0), b, ["k"], "o", count_col="n", num_partitions=4)
    assert out2.count() == 0


def test_ordered_counts_more_partitions_than_rows(spark):
    p = spark.createDataFrame([(1, 1, 5), (2, 2, 7)], "pid long, k long, o long")
    b = spark.createDataFrame([(1, 1), (1, 4), (1, 5), (2, 8)], "k long, o long")
    out, _ = ordered_counts(p, b, ["k"], "o", count_col="n", num_partitions=50)
    assert sorted((r["pid"], r["n"]) for r in out.collect()) == [(1, 2), (2, 0)]


@pytest.mark.parametrize("block,per_salt", [(3, 100_000), (7, 100_000), (4, 20)])
def test_small_rank_blocks_and_salts(spark, monkeypatch, block, per_salt):
    """Schedules with more earlier invitations than one block span several (key,
    block) join keys, and requested blocks are salted; the bag must not change."""
    monkeypatch.setattr(signup_time, "RANK_BLOCK", block)
    monkeypatch.setattr(signup_time, "REQUESTS_PER_SALT", per_salt)
    log = hot_user_log(spark)
    split = signup_time.report(log, 10_000, num_partitions=6)
    joined = signup_time.report(log, float("inf"))
    assert split.exceptAll(joined).count() == 0 and joined.exceptAll(split).count() == 0
