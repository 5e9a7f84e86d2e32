"""Golden rows: fixtures A and B."""

from collections import Counter

import pytest

from auditmart.plans import daily_cancel, program_audit, signup_time, waitlist
from fixtures import (
    AUDIT_A, AUDIT_B, DAILY_CANCEL_A, DAILY_CANCEL_B, PROGRAM_AUDIT_A, PROGRAM_AUDIT_B,
    SIGNUP_A, SIGNUP_B, SLOTS_A, SLOTS_B, STATES_A, STATES_B, WAITLIST_A, WAITLIST_B,
    audit_df, slots_df, states_df,
)

CASES = {
    "A": (AUDIT_A, SLOTS_A, STATES_A),
    "B": (AUDIT_B, SLOTS_B, STATES_B),
}


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module", params=["A", "B"])
def case(request, spark):
    a, s, st = CASES[request.param]
    return request.param, audit_df(spark, a), slots_df(spark, s), states_df(spark, st)


def test_program_audit(case):
    name, audit, slots, _ = case
    out = program_audit.report(audit, slots)
    assert out.columns == program_audit.REPORT_COLUMNS
    expected = PROGRAM_AUDIT_A if name == "A" else PROGRAM_AUDIT_B
    assert bag(out.collect()) == bag(expected)


def test_waitlist(case):
    name, audit, _, states = case
    out = waitlist.report(audit, states)
    assert out.columns == waitlist.REPORT_COLUMNS
    expected = WAITLIST_A if name == "A" else WAITLIST_B
    assert bag(out.collect()) == bag(expected)


@pytest.mark.parametrize("max_pairs", [float("inf"), 1, -1, signup_time.MAX_PAIRS_PER_USER])
def test_signup_time_is_a_bag(case, max_pairs):
    """No hot key, some hot keys, all keys hot, and the default bound."""
    name, audit, _, _ = case
    out = signup_time.report(audit, max_pairs)
    assert out.columns == signup_time.REPORT_COLUMNS
    expected = SIGNUP_A if name == "A" else SIGNUP_B
    assert bag(out.collect()) == bag(expected)


def test_daily_cancel(case):
    name, audit, _, _ = case
    out = daily_cancel.report(audit)
    assert out.columns == daily_cancel.REPORT_COLUMNS
    expected = DAILY_CANCEL_A if name == "A" else DAILY_CANCEL_B
    assert bag(out.collect()) == bag(expected)


def test_report_types(case):
    _, audit, slots, states = case
    pa = dict(program_audit.report(audit, slots).dtypes)
    assert pa["total_invites"] == "bigint" and pa["first_invite_day"] == "date"
    assert pa["after_first_day_overage_rate"] == "double"
    wl = dict(waitlist.report(audit, states).dtypes)
    assert wl["total_waitlisted_to_canceled"] == "bigint" and wl["percent_waitlisted"] == "double"
    assert dict(signup_time.report(audit).dtypes)["signup_time"] == "bigint"
    assert dict(daily_cancel.report(audit).dtypes)["created_date"] == "date"


def test_q15_repeated_schedules_count_once(spark):
    """Q15: waitlisted-to-scheduled is a semi join; a user who scheduled three
    times (before or after the waitlist, no time test) still counts once per
    first-action waitlisted application."""
    rows = [
        (9, 1, 90, 50, 1, None, None, "2017-11-01 00:00:00"),
        (9, 1, 50, 50, 3, 700, 9050, "2017-11-02 00:00:00"),
        (9, 1, 50, 50, 2, 700, None, "2017-11-03 00:00:00"),
        (9, 1, 50, 50, 2, 701, None, "2017-11-04 00:00:00"),
        (9, 1, 50, 50, 2, 702, None, "2017-11-01 12:00:00"),
    ]
    # actor 50 scheduled (11-01 12:00) before waitlisting, so is not a
    # first-action waitlister; actor 51 waitlisted first, then scheduled 3x
    rows += [
        (9, 1, 51, 51, 3, 700, 9051, "2017-11-02 00:00:00"),
        (9, 1, 51, 51, 2, 700, None, "2017-11-03 00:00:00"),
        (9, 1, 51, 51, 2, 701, None, "2017-11-04 00:00:00"),
        (9, 1, 51, 51, 2, 702, None, "2017-11-05 00:00:00"),
    ]
    audit = audit_df(spark, rows)
    st = states_df(spark, [(9050, 1), (9051, 1)])
    out = {r["program_id"]: r for r in waitlist.base(audit, st).collect()}
    assert out[9]["total_waitlisted"] == 1  # only actor 51 (actor 50 acted first by scheduling)
    assert out[9]["total_waitlisted_to_scheduled"] == 1  # three schedules, counted once


def test_q19_duplicate_programs_multiply_withdraw_and_cancel(spark):
    """Q19: the source counts withdrawals and cancellations after a left join
    to the program table, so a program listed twice counts them twice."""
    from auditmart import model as m

    audit, slots = audit_df(spark, AUDIT_A), slots_df(spark, SLOTS_A)
    programs = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], m.PROGRAM_SCHEMA)
    fused = {r["program_id"]: r for r in program_audit.base(audit, slots, programs).collect()}
    assert (fused[1]["total_withdraw"], fused[1]["total_cancel"]) == (2, 4)  # 1 and 2, doubled
    assert fused[1]["total_invites"] == 3  # invitations are not joined to the program table


def test_daily_cancel_from_the_shared_day_table(case):
    """R4 derived from R1's day table equals R4 computed on its own."""
    _, audit, _, _ = case
    per_day = program_audit.daily_measures(audit)
    assert bag(daily_cancel.report_from_daily(per_day).collect()) == bag(daily_cancel.report(audit).collect())
