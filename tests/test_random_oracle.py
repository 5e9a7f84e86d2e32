"""Randomised differential tests: adversarial audit logs (null keys and times,
timestamp ties, duplicate rows, a hot user, non-unique application states)
through the Spark plans and through the DuckDB definitions."""

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest

from auditmart import model as m
from auditmart import oracle_sql as o
from auditmart.plans import daily_cancel, program_audit, signup_time, waitlist
from check_oracle import bag

BASE = dt.datetime(2017, 9, 1)


def _maybe(rnd, p, value):
    return None if rnd.random() < p else value


def gen_audit(rnd, n):
    rows = []
    for _ in range(n):
        user = 1 if rnd.random() < 0.35 else _maybe(rnd, 0.03, rnd.randint(2, 9))  # user 1 is hot
        ts = _maybe(rnd, 0.06, BASE + dt.timedelta(minutes=rnd.choice(range(0, 6 * 24 * 60, 90))))
        rows.append(
            (
                _maybe(rnd, 0.05, rnd.randint(1, 3)),  # program
                _maybe(rnd, 0.1, user),  # created_by
                _maybe(rnd, 0.05, rnd.randint(1, 2)),  # season
                _maybe(rnd, 0.03, rnd.randint(1, 5)),  # operation
                _maybe(rnd, 0.2, rnd.randint(100, 102)),  # interview event
                ts,
                user,
                _maybe(rnd, 0.3, None if user is None else user * 10 + rnd.randint(0, 2)),
            )
        )
    rows += rnd.sample(rows, n // 10)  # exact duplicates
    return rows


def gen_slots(rnd):
    return [(_maybe(rnd, 0.1, rnd.randint(0, 4)), _maybe(rnd, 0.1, rnd.randint(1, 2)), _maybe(rnd, 0.1, rnd.randint(0, 9))) for _ in range(25)]


def gen_states(rnd):
    apps = [u * 10 + k for u in range(1, 10) for k in range(3)]
    return [(_maybe(rnd, 0.05, rnd.choice(apps)), _maybe(rnd, 0.05, rnd.randint(1, 5))) for _ in range(40)]


def arrow(rows, schema):
    cols = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    types = {"bigint": pa.int64(), "int": pa.int32(), "timestamp_ntz": pa.timestamp("us")}
    return pa.table({f.name: pa.array(list(c), types[f.dataType.simpleString()]) for f, c in zip(schema.fields, cols)})


def gen_programs(rnd):
    """Program table with duplicate ids (the warehouse does not enforce keys)."""
    return [(p, rnd.randint(1, 3)) for p in range(0, 5) for _ in range(rnd.choice([0, 1, 1, 2, 3]))]


def strip_mapping(sql: str) -> str:
    for cte in (o.AUDIT_DIM, o.SLOT_DIM, o.STATE_DIM, o.PROGRAM_FACT):
        sql = sql.replace(cte + ",\n", "")
    return sql.replace("WITH " + o.AUDIT_DIM + "\n", "")


def duck_rows(con, sql):
    rel = con.sql(strip_mapping(sql))
    return list(rel.columns), rel.fetchall()


def same(df, duck):
    d_cols, d_rows = duck
    s_rows = [tuple(r) for r in df.collect()]
    s_order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    assert sorted(df.columns) == sorted(d_cols)
    return bag(s_rows, s_order) == bag(d_rows, d_order)


@pytest.mark.parametrize("seed", [11, 23, 37, 41])
def test_reports_match_sql_on_adversarial_logs(spark, seed):
    rnd = random.Random(seed)
    audit_rows, slot_rows, state_rows = gen_audit(rnd, 400), gen_slots(rnd), gen_states(rnd)
    program_rows = gen_programs(rnd)
    programs = spark.createDataFrame(program_rows, m.PROGRAM_SCHEMA)
    audit = spark.createDataFrame(audit_rows, m.AUDIT_SCHEMA)
    slots = spark.createDataFrame(slot_rows, m.SLOT_SCHEMA)
    states = spark.createDataFrame(state_rows, m.APPLICATION_STATE_SCHEMA)
    con = duckdb.connect()
    con.register("audit_dim", arrow(audit_rows, m.AUDIT_SCHEMA))
    con.register("track_tier_slot_dim", arrow(slot_rows, m.SLOT_SCHEMA))
    con.register("application_state_dim", arrow(state_rows, m.APPLICATION_STATE_SCHEMA))
    con.register("program_fact", arrow(program_rows, m.PROGRAM_SCHEMA))

    assert same(program_audit.report(audit, slots, programs), duck_rows(con, o.PA_REPORT))
    assert same(program_audit.base(audit, slots, programs), duck_rows(con, o.PA + "SELECT * FROM pa_base"))
    assert same(waitlist.report(audit, states), duck_rows(con, o.WL_REPORT))
    assert same(waitlist.base(audit, states), duck_rows(con, o.WL + "SELECT * FROM wl_base"))
    sbw = duck_rows(con, o.SU_PAIRS)
    su = duck_rows(con, o.SU_REPORT)
    for max_pairs in (float("inf"), 40, -1):  # no, some and all keys are hot
        assert same(signup_time.schedule_before_waitlist(audit, max_pairs, num_partitions=5), sbw)
        assert same(signup_time.report(audit, max_pairs, num_partitions=5), su)
    assert same(daily_cancel.report(audit), duck_rows(con, o.DAILY_CANCEL))
