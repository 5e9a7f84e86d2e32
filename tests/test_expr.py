"""Expression cases (FIXTURES.md §3, 'Expression cases')."""

import datetime as dt

from pyspark.sql import functions as F

from auditmart.functions import epoch_seconds, nvl_zero, percent, round_div, seconds_between


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_round_div_zero_denominator_is_null(spark):
    assert one(spark, round_div(F.lit(5), F.lit(0), 2)) is None


def test_round_half_up(spark):
    assert one(spark, F.round(F.lit(1.005), 2)) == 1.01
    assert one(spark, F.round(F.lit(2.675), 2)) == 2.68
    assert one(spark, F.round(F.lit(-0.125), 2)) == -0.13


def test_percent(spark):
    assert one(spark, percent(F.lit(1), F.lit(16), 1)) == 6.3
    assert one(spark, percent(F.lit(1), F.lit(8), 1)) == 12.5
    assert one(spark, percent(F.lit(3), F.lit(1), 1)) == 300.0  # not capped
    assert one(spark, percent(F.lit(1), F.lit(0), 1)) is None


def test_q1_precedence(spark):
    # the source's unparenthesised numerator: 10 - 4/3, not (10 - 4)/3
    assert one(spark, F.round(F.lit(10) - F.try_divide(F.lit(4), F.lit(3)), 2)) == 8.67
    assert one(spark, round_div(F.lit(10) - F.lit(4), F.lit(3), 2)) == 2.0


def test_nvl_zero(spark):
    assert one(spark, nvl_zero(F.lit(None).cast("bigint"))) == 0
    assert one(spark, nvl_zero(F.lit(7).cast("bigint"))) == 7


def test_seconds_between_floor_semantics(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000)),
         (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1, 0, 0, 0, 0))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    rows = df.select(seconds_between("a", "b").alias("s"), epoch_seconds("a").alias("ea")).collect()
    # unix_timestamp floors each side: 1 - 0 = 1 although only 0.2 s elapsed
    assert rows[0]["s"] == 1
    assert rows[1]["ea"] == -1 and rows[1]["s"] == 1


def test_seconds_between_is_time_zone_independent(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 4, 0))], "a timestamp_ntz, b timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(seconds_between("a", "b").alias("s")).first()["s"] == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_seconds_between_over_both_clock_changes(spark):
    """Instants and zone-less timestamps, in New York and in UTC, over the
    spring gap and the autumn hour.  Expected values come from the calendar."""
    ltz = [  # UTC text pairs
        ("2024-03-10 06:30:00", "2024-03-10 07:30:00", 3600),  # 01:30 EST to 03:30 EDT
        ("2024-11-03 05:30:00", "2024-11-03 06:30:00", 3600),  # 01:30 EDT to 01:30 EST
    ]
    ntz = [
        ("2024-03-10 01:30:00", "2024-03-10 02:30:00", 3600),  # a clock that knows no gap
        ("2024-11-03 01:30:00", "2024-11-03 03:30:00.5", 7200),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00", 1),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for cases, kind, mark in ((ltz, "timestamp", "+00:00"), (ntz, "timestamp_ntz", "")):
                for a, b, want in cases:
                    start, end = (F.lit(x + mark).cast(kind) for x in (a, b))
                    assert one(spark, seconds_between(start, end)) == want, (zone, kind, a)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_signup_time_keeps_instants(spark):
    """An invitation at 01:30 and a sign-up at 03:30 on the day New York's
    clocks go forward are an hour apart, in every zone and plan."""
    from auditmart.operators.audit import audit_base
    from auditmart.plans import signup_time

    rows = [
        (1, 5, 1, 1, None, "2024-03-10 06:30:00+00:00", 5, None),
        (1, 5, 1, 2, 9, "2024-03-10 07:30:00+00:00", 5, None),
        (1, 5, 1, 3, 9, "2024-03-11 07:30:00+00:00", 5, 50),
        (1, 6, 1, 1, None, "2024-11-03 05:45:00+00:00", 6, None),  # 01:45 EDT
        (1, 6, 1, 2, 9, "2024-11-03 06:15:00+00:00", 6, None),  # 01:15 EST, half an hour later
        (1, 6, 1, 3, 9, None, 6, 60),
    ]
    columns = (
        "program_id long, created_by_user_id long, calendar_season_id long, audit_operation_id int, "
        "interview_event_id long, at string, user_id long, application_id long"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            log = spark.createDataFrame(rows, columns).withColumn("created_date", F.col("at").cast("timestamp"))
            audit = audit_base(log)
            assert dict(audit.dtypes)["created_date"] == "timestamp"
            for max_pairs in (float("inf"), -1):
                got = sorted((r["user_id"], r["signup_time"]) for r in signup_time.report(audit, max_pairs).collect())
                assert got == [(5, 3600), (6, 1800)], (zone, max_pairs, got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
