"""All reports on a skewed log derived from the given tables: one program and
one user hold a third of the rows each.  The Spark plans are compared with the
source-shaped SQL run by DuckDB on the same derived rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from auditmart import oracle_sql as o
from auditmart.plans import daily_cancel, program_audit, signup_time, waitlist
from auditmart.queries import audit, programs, slots, states
from conftest import SF
from test_random_oracle import duck_rows, same


@pytest.fixture(scope="module")
def skewed(spark):
    a = audit(spark, SF["0.01"])
    hot_user = F.col("user_id") % 3 == 0
    hot = a.withColumn("program_id", F.when(F.col("application_id") % 3 == 1, F.lit(1)).otherwise(F.col("program_id")))
    hot = hot.withColumn("user_id", F.when(hot_user, F.lit(1)).otherwise(F.col("user_id")))
    hot = hot.withColumn(
        "created_by_user_id", F.when(F.col("created_by_user_id") % 3 == 0, F.lit(1)).otherwise(F.col("created_by_user_id"))
    )
    s, st, prg = slots(spark, SF["0.01"]), states(spark, SF["0.01"]), programs(spark, SF["0.01"])
    con = duckdb.connect()
    con.register("audit_dim", hot.toArrow())
    con.register("track_tier_slot_dim", s.toArrow())
    con.register("application_state_dim", st.toArrow())
    con.register("program_fact", prg.toArrow())
    return hot, s, st, prg, con


def test_program_audit_on_skewed_log(skewed):
    hot, s, _, prg, con = skewed
    assert same(program_audit.report(hot, s, prg), duck_rows(con, o.PA_REPORT))


def test_waitlist_on_skewed_log(skewed):
    hot, _, st, _, con = skewed
    assert same(waitlist.report(hot, st), duck_rows(con, o.WL_REPORT))


def test_daily_cancel_on_skewed_log(skewed):
    hot, _, _, _, con = skewed
    assert same(daily_cancel.report(hot), duck_rows(con, o.DAILY_CANCEL))


@pytest.mark.parametrize("max_pairs", [float("inf"), 10_000])
def test_signup_time_on_skewed_log(skewed, max_pairs):
    hot, _, _, _, con = skewed
    assert same(signup_time.report(hot, max_pairs), duck_rows(con, o.SU_REPORT))
