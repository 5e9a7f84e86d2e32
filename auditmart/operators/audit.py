"""Audit-log operators: operation filters, grouped measures and the join shapes
the reports are built from.

Every function maps DataFrames to a DataFrame and never triggers an action.
Joins are by column name (null keys never match, as in the source).  Grouped
counts are ordinary hash aggregates, so Spark pre-aggregates them map-side and
a hot (program, season) or user costs one partial row per task, not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as m

K = m.GROUP_KEYS
ACTOR_KEYS = [m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.CREATED_BY_USER_ID]

WAITLIST_DATE = "waitlist_date"
FIRST_ACTION_DATE = "first_action_date"
FIRST_WAITLIST_DATE = "first_waitlist_date"
HAS_SCHEDULED = "has_scheduled"


def op_is(code: int) -> Column:
    return F.col(m.AUDIT_OPERATION_ID) == F.lit(code)


def created_day() -> Column:
    return F.col(m.CREATED_DATE).cast("date")


# --- key contracts ---------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once.  The warehouse does not enforce primary
    keys; this is how a job or a test checks them (an aggregate, no collect of the
    table)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


# --- S4 / P1-P5: projections ---------------------------------------------------


def audit_base(audit: DataFrame) -> DataFrame:
    """The 8-column audit projection every report starts from."""
    return m.conform(audit, m.AUDIT_SCHEMA)


def with_specialty(audit: DataFrame, programs: DataFrame) -> DataFrame:
    """Partial audit enriched with the program's specialty.  The
    program table is a dimension; Spark broadcasts it when its estimated size
    is under ``autoBroadcastJoinThreshold`` (AQE re-checks the runtime size)
    and falls back to a sort-merge join otherwise."""
    pa = audit.select(m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.AUDIT_OPERATION_ID, m.CREATED_DATE)
    prg = programs.select(m.PROGRAM_ID, m.SPECIALTY_ID)
    return pa.join(prg, m.PROGRAM_ID, "left").select(
        m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.AUDIT_OPERATION_ID, m.CREATED_DATE, m.SPECIALTY_ID
    )


def invite_days(audit: DataFrame) -> DataFrame:
    """P4 + F2: invitations with their calendar day."""
    return audit.where(op_is(m.INVITE)).select(
        m.PROGRAM_ID, m.CALENDAR_SEASON_ID, created_day().alias(m.CREATED_DATE)
    )


def ops_with_specialty(audit: DataFrame, programs: DataFrame, code: int) -> DataFrame:
    """rows of one operation from the enriched partial audit (withdrawals,
    cancellations), operation column dropped."""
    return with_specialty(audit, programs).where(op_is(code)).drop(m.AUDIT_OPERATION_ID)


def program_multiplicity(programs: DataFrame) -> DataFrame:
    """Rows per program id in the program table.  The source counts
    withdrawals and cancellations after a left join to that table, so a
    program listed ``k`` times counts them ``k`` times (SURVEY Q19).  A program
    absent from the table keeps factor 1 (``coalesce(k, 1)`` at the join)."""
    return (
        programs.where(F.col(m.PROGRAM_ID).isNotNull())
        .groupBy(m.PROGRAM_ID)
        .agg(F.count(F.lit(1)).alias("_program_rows"))
    )


# --- A1-A6: program-audit measures ---------------------------------------------


def total_slots(slots: DataFrame) -> DataFrame:
    """A1: available slots per (program, season); null keys form a group."""
    return slots.groupBy(*K).agg(F.sum(m.ALL_TIER_QUANTITY).alias("total_slots"))


def count_op(audit: DataFrame, code: int, name: str, on_day: bool = False) -> DataFrame:
    """``count(created_date)`` of one operation per group (nulls
    not counted, the group still exists)."""
    value = created_day() if on_day else F.col(m.CREATED_DATE)
    return audit.where(op_is(code)).groupBy(*K).agg(F.count(value).alias(name))


def count_op_by_program(audit: DataFrame, programs: DataFrame, code: int, name: str) -> DataFrame:
    """A3 / A4: ``count(created_date)`` of one operation per group after the left
    join to the program table (Q19).  Rows are counted per group first; only the
    groups meet the program table's row counts, so no raw row is shuffled."""
    factor = F.coalesce(F.col("_program_rows"), F.lit(1))
    return count_op(audit, code, name).join(program_multiplicity(programs), m.PROGRAM_ID, "left").select(
        *K, (F.col(name) * factor).alias(name)
    )


def first_invite_day(audit: DataFrame) -> DataFrame:
    """A5: first day with an invitation per group."""
    return invite_days(audit).groupBy(*K).agg(F.min(m.CREATED_DATE).alias("first_invite_day"))


def invites_per_day(audit: DataFrame) -> DataFrame:
    """Invitations per (program, season, day), the grain J4 needs."""
    return (
        invite_days(audit)
        .where(F.col(m.CREATED_DATE).isNotNull())
        .groupBy(*K, m.CREATED_DATE)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def first_day_invites(audit: DataFrame) -> DataFrame:
    """Invitations sent on the group's first invitation day.

    The source joins the invitations back to their own ``min(day)``.  Here the
    day-level counts are aggregated once more with ``min_by``; no self-join,
    no window.  Groups with a null key never matched that equi-join, so they
    are dropped."""
    return (
        invites_per_day(audit)
        .groupBy(*K)
        .agg(F.min_by("n", m.CREATED_DATE).alias("total_first_day_invites"))
        .where(F.col(m.PROGRAM_ID).isNotNull() & F.col(m.CALENDAR_SEASON_ID).isNotNull())
    )


# --- A7-A16, J5-J7: waitlist measures -------------------------------------------


def first_action_date(audit: DataFrame) -> DataFrame:
    """A user's first operation of any kind per (program, season)."""
    return audit.groupBy(*ACTOR_KEYS).agg(F.min(m.CREATED_DATE).alias(FIRST_ACTION_DATE))


def is_waitlist_signup() -> Column:
    return op_is(m.SIGNUP_WAITLIST) & F.col(m.APPLICATION_ID).isNotNull()


def waitlist_signups(audit: DataFrame) -> DataFrame:
    """A15 + F3: distinct waitlist sign-ups that carry an application."""
    return (
        audit.where(is_waitlist_signup())
        .select(*ACTOR_KEYS, F.col(m.CREATED_DATE).alias(WAITLIST_DATE), m.APPLICATION_ID)
        .dropDuplicates()
    )


def actor_summary(audit: DataFrame) -> DataFrame:
    """One pass over the log per (program, season, actor): first action, first
    waitlist sign-up with an application and whether the actor ever scheduled an
    interview.  Partial aggregation keeps a hot actor to one row per map task."""
    ts = F.col(m.CREATED_DATE)
    return audit.groupBy(*ACTOR_KEYS).agg(
        F.min(ts).alias(FIRST_ACTION_DATE),
        F.min(F.when(is_waitlist_signup(), ts)).alias(FIRST_WAITLIST_DATE),
        F.max(op_is(m.SIGNUP_INTERVIEW)).alias(HAS_SCHEDULED),
    )


def first_action_waitlist(audit: DataFrame, colocated: bool = False) -> DataFrame:
    """Applications waitlisted at the moment of the user's first action.

    Only actors whose earliest waitlist sign-up equals their first action can
    match, so the per-actor summary is reduced to those before the join (an
    exact semi-join reduction).  The join is on (program, season, actor,
    timestamp): hashing on the timestamp too spreads a hot actor over many
    partitions.  De-duplication after the join equals the source's
    de-duplication before it because the summary is unique per actor.

    ``colocated``: the log is stored in buckets of the actor keys without hot actors
    (:mod:`auditmart.plans.colocated`).  The join then uses these keys alone, the
    timestamp as a residual, so that no step of this function shuffles."""
    firsts = actor_summary(audit).where(F.col(FIRST_WAITLIST_DATE) == F.col(FIRST_ACTION_DATE)).select(
        *ACTOR_KEYS, F.col(FIRST_ACTION_DATE).alias(WAITLIST_DATE), HAS_SCHEDULED
    )
    signups = audit.where(is_waitlist_signup()).select(
        *ACTOR_KEYS, F.col(m.CREATED_DATE).alias(WAITLIST_DATE), m.APPLICATION_ID
    )
    if colocated:
        # two inequalities: an equality would become a fourth join key and shuffle both sides
        at_first = F.col(WAITLIST_DATE).between(F.col("_first"), F.col("_first"))
        joined = signups.join(firsts.withColumnRenamed(WAITLIST_DATE, "_first"), ACTOR_KEYS).where(at_first)
    else:
        joined = signups.join(firsts, [*ACTOR_KEYS, WAITLIST_DATE])
    return joined.select(*ACTOR_KEYS, m.APPLICATION_ID, HAS_SCHEDULED).dropDuplicates([*ACTOR_KEYS, m.APPLICATION_ID])


def scheduled_users(audit: DataFrame) -> DataFrame:
    """Distinct (program, season, actor) with an interview sign-up."""
    return audit.where(op_is(m.SIGNUP_INTERVIEW)).select(*ACTOR_KEYS).dropDuplicates()


def waitlisted_scheduled_users(faw: DataFrame, scheduled: DataFrame) -> DataFrame:
    """First-action waitlisters who also scheduled.  The source's inner
    join against a key-distinct table is a semi join (one row per waitlisted
    application, no time-order test)."""
    return faw.select(*ACTOR_KEYS).join(scheduled, ACTOR_KEYS, "left_semi")


def application_states(states: DataFrame, codes: list[int]) -> DataFrame:
    """Applications whose interview status is in ``codes``."""
    return states.where(F.col(m.INTERVIEW_STATUS_ID).isin(codes)).select(m.APPLICATION_ID)


def count_by_group(df: DataFrame, col: str, name: str) -> DataFrame:
    """``count(col)`` per (program, season)."""
    return df.groupBy(*K).agg(F.count(col).alias(name))


def waitlisted_to_state(faw: DataFrame, state_apps: DataFrame, name: str) -> DataFrame:
    """Waitlisted applications found in a state subset."""
    return (
        faw.select(*K, m.APPLICATION_ID)
        .join(state_apps, m.APPLICATION_ID)
        .groupBy(*K)
        .agg(F.count(m.APPLICATION_ID).alias(name))
    )


def state_counts(states: DataFrame) -> DataFrame:
    """Per application: how many state rows fall in each report bucket.  Unique
    per application, so a left join to it cannot multiply rows, and summing the
    bucket counts equals counting the matches of the three inner joins."""
    status = F.col(m.INTERVIEW_STATUS_ID)
    return (
        states.where(F.col(m.APPLICATION_ID).isNotNull())
        .groupBy(m.APPLICATION_ID)
        .agg(
            F.count(F.when(status == m.STATUS_COMPLETED, 1)).alias("n_completed"),
            F.count(F.when(status.isin(m.STATUS_CANCELED_OR_MISSED), 1)).alias("n_canceled"),
            F.count(F.when(status == m.STATUS_WITHDRAWN, 1)).alias("n_withdrawn"),
        )
    )


# --- A14: daily cancellations ------------------------------------------------


def daily_cancels(audit: DataFrame) -> DataFrame:
    """Cancellations per (program, season, day), counting actors."""
    return (
        audit.where(op_is(m.CANCEL_INTERVIEW))
        .select(*K, m.CREATED_BY_USER_ID, created_day().alias(m.CREATED_DATE))
        .groupBy(*K, m.CREATED_DATE)
        .agg(F.count(m.CREATED_BY_USER_ID).alias("daily_cancel"))
    )
