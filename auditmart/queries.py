"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each reading the driver's tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs
from . import model as m
from .functions import nvl_zero, percent, round_div, seconds_between
from .operators import audit as ops
from .plans import colocated, daily_cancel, maintained, program_audit, signup_time, waitlist
from .sources import cluster, range_predicates, read_table, scratch_path, split_points, write_table
from .sources import driver_tables as dt
from .sources import file_index, ledger
from .sources.staging import denormalize, incremental_load, stage_full_copy
from .streaming import single_file_glob, stage_new_files

Query = Callable[[SparkSession, str], DataFrame]
HOT_PAIRS = 100  # of the hot_users query


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.audit_base(dt.audit_dim(spark, sf_dir))


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(dt.track_tier_slot_dim(spark, sf_dir), m.SLOT_SCHEMA)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(dt.application_state_dim(spark, sf_dir), m.APPLICATION_STATE_SCHEMA)


def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.conform(dt.program_fact(spark, sf_dir), m.PROGRAM_SCHEMA)


# --- sources / sinks -----------------------------------------------------------


def q_scan_table(spark, sf_dir):
    return read_table(spark, dt.table_path(sf_dir, "lineitem"))


def q_scan_clustered(spark, sf_dir):
    return cluster(audit(spark, sf_dir), [m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.CREATED_DATE])


def q_write_roundtrip(spark, sf_dir):
    target = scratch_path(spark, "report/daily_cancel")
    write_table(daily_cancel.report(audit(spark, sf_dir)), target)  # default mode: append
    return read_table(spark, target)


def q_staging_full_copy(spark, sf_dir):
    return stage_full_copy(spark, dt.table_path(sf_dir, "documents"), scratch_path(spark, "staging/documents"))


def q_warehouse_denormalize(spark, sf_dir):
    lineitem = read_table(spark, dt.table_path(sf_dir, "lineitem"))
    orders = read_table(spark, dt.table_path(sf_dir, "orders"))
    return denormalize(lineitem, orders, "l_orderkey", "o_orderkey", ["o_custkey", "o_orderdate"])


def q_staging_incremental(spark, sf_dir):
    """Initial load of the log up to the season cut-off, then two incremental
    loads from the whole source: every row is staged once."""
    source = read_table(spark, dt.table_path(sf_dir, "events"))
    target = scratch_path(spark, "staging/events")
    cutoff = F.lit(dt.SEASON_CUTOFF).cast("timestamp_ntz")
    for part in (source.where(F.col("ts") < cutoff), source, source):
        incremental_load(spark, part, target, ["event_id"])
    return read_table(spark, target)


def q_staging_incremental_stream(spark, sf_dir):
    """W2 as a file-stream job: the run stages every file of the source not
    yet recorded in its checkpoint; a second run stages nothing."""
    src = dt.table_path(sf_dir, "events")
    schema = read_table(spark, src).schema
    base = scratch_path(spark, "staging/events_stream")
    target, ckpt = f"{base}/table", f"{base}/_checkpoint"
    for _ in range(2):  # the rerun is a no-op: exactly-once per file
        stage_new_files(spark, single_file_glob(src), schema, target, ckpt)
    return read_table(spark, target)


def q_staging_incremental_indexed(spark, sf_dir):
    """The log in four batches by time, each with rows that an earlier one held; a
    load reads only the staged files that may hold one of its keys."""
    source = read_table(spark, dt.table_path(sf_dir, "events"))
    target = scratch_path(spark, "staging/events_indexed")
    days = ["2024-01-01", "2024-01-09", "2024-01-16", "2024-01-23"]
    for i, day in enumerate(days):
        ts = F.col("ts")
        last = F.lit("9999-01-01" if i + 1 == len(days) else days[i + 1]).cast("timestamp_ntz")
        first = F.lit("0001-01-01" if i == 0 else days[i - 1]).cast("timestamp_ntz")  # from the batch before on
        file_index.indexed_load(spark, source.where((ts >= first) & (ts < last)), target, ["event_id"])
    file_index.indexed_load(spark, source.where("ts IS NULL"), target, ["event_id"])
    return read_table(spark, target)


def q_scan_interleaved(spark, sf_dir):
    target = scratch_path(spark, "warehouse/audit_interleaved")
    file_index.write_interleaved(audit(spark, sf_dir), target, jobs.AUDIT_LAYOUT)
    return ops.audit_base(read_table(spark, target))


def q_daily_cancel_interleaved(spark, sf_dir):
    """R4 from the files of the interleaved log that may hold cancellations."""
    target = scratch_path(spark, "warehouse/audit_interleaved")
    file_index.write_interleaved(audit(spark, sf_dir), target, jobs.AUDIT_LAYOUT)
    cancels = file_index.read_where(spark, target, {m.AUDIT_OPERATION_ID: (m.CANCEL_INTERVIEW, m.CANCEL_INTERVIEW)})
    return daily_cancel.report(ops.audit_base(cancels))


def q_hot_users(spark, sf_dir):
    """The users that could make more than 100 schedule-waitlist pairs, and how many."""
    a = audit(spark, sf_dir)
    hot = signup_time.hot_users(a, HOT_PAIRS, invitations=False)
    op, at_event = F.col(m.AUDIT_OPERATION_ID), F.col(m.INTERVIEW_EVENT_ID).isNotNull()
    counts = a.where(at_event).join(hot, m.USER_ID, "left_semi").groupBy(m.USER_ID).agg(
        F.count(F.when(op == m.SIGNUP_INTERVIEW, 1)).alias("n_schedules"),
        F.count(F.when(op == m.SIGNUP_WAITLIST, 1)).alias("n_waitlists"),
    )
    return counts.where(F.col("n_schedules") * F.col("n_waitlists") > HOT_PAIRS)  # the sketch may name more


def q_staging_split_rows(spark, sf_dir):
    """Orders in 16 ranges of their customer key, as a range-partitioned read would deal
    them: rows found in total and rows met twice or not at all."""
    orders = read_table(spark, dt.table_path(sf_dir, "orders"))
    conditions = range_predicates("o_custkey", split_points(orders, "o_custkey", 16))
    met = sum((F.when(F.expr(c), 1).otherwise(0) for c in conditions), F.lit(0))
    return orders.select(met.alias("met")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("met") != 1, 1)).alias("n_wrong")
    )


def q_write_ledger(spark, sf_dir):
    """R4 written season by season, each write tried twice."""
    target = scratch_path(spark, "report/daily_cancel_batches")
    report = daily_cancel.report(audit(spark, sf_dir))
    season = F.col(m.CALENDAR_SEASON_ID)
    parts = {"first": season == 1, "rest": ~season.eqNullSafe(1)}
    for batch_id, part in parts.items():
        for _ in range(2):
            ledger.write_batch(report.where(part), target, batch_id)
    return ledger.read_batches(spark, target)


def _maintained(spark, sf_dir):
    """Day counts kept over three loads by event id, with days that reach into each
    other, and a repeated load."""
    state = scratch_path(spark, "maintained")
    a, ids = dt.audit_dim, F.col("event_id") % 3
    raw = read_table(spark, dt.table_path(sf_dir, "events"))
    for part in (0, 1, 1, 2):
        maintained.maintain(ops.audit_base(a(spark, sf_dir, raw.where(ids == part))), state, f"load-{part}")
    return state


def q_program_audit_maintained(spark, sf_dir):
    return maintained.program_audit_report(spark, _maintained(spark, sf_dir), slots(spark, sf_dir), programs(spark, sf_dir))


def q_daily_cancel_maintained(spark, sf_dir):
    return maintained.daily_cancel_report(spark, _maintained(spark, sf_dir))


def q_interview_events(spark, sf_dir):
    return m.conform(dt.interview_event_dim(spark, sf_dir), m.INTERVIEW_EVENT_SCHEMA)


def q_warehouse_pipeline(spark, sf_dir):
    """Stage the source tables, build the stored warehouse tables, and compute
    R1 from them."""
    return jobs.pipeline_report(spark, sf_dir, scratch_path(spark, "pipeline"))


def _stored_report(name: str) -> Query:
    """A report as the chain writes it: staged, stored in the interleaved warehouse,
    computed from there."""

    def q(spark, sf_dir):
        wh = jobs.pipeline_reports(spark, sf_dir, scratch_path(spark, "pipeline"))
        return read_table(spark, getattr(wh, f"{name}_report"))

    return q


q_warehouse_waitlist = _stored_report("waitlist")
q_warehouse_signup_time = _stored_report("signup_time")
q_warehouse_daily_cancel = _stored_report("daily_cancel")


# --- projections / filters -------------------------------------------------------


def q_audit_base(spark, sf_dir):
    return audit(spark, sf_dir)


def q_audit_with_specialty(spark, sf_dir):
    return ops.with_specialty(audit(spark, sf_dir), programs(spark, sf_dir))


def q_invite_days(spark, sf_dir):
    return ops.invite_days(audit(spark, sf_dir))


def q_withdraw_ops(spark, sf_dir):
    return ops.ops_with_specialty(audit(spark, sf_dir), programs(spark, sf_dir), m.WITHDRAW)


def q_cancel_ops(spark, sf_dir):
    return ops.ops_with_specialty(audit(spark, sf_dir), programs(spark, sf_dir), m.CANCEL_INTERVIEW)


# --- program audit ---------------------------------------------------------------


def q_total_slots(spark, sf_dir):
    return ops.total_slots(slots(spark, sf_dir))


def q_total_invites(spark, sf_dir):
    return ops.count_op(audit(spark, sf_dir), m.INVITE, "total_invites", on_day=True)


def q_total_withdraw(spark, sf_dir):
    return ops.count_op_by_program(audit(spark, sf_dir), programs(spark, sf_dir), m.WITHDRAW, "total_withdraw")


def q_total_cancel(spark, sf_dir):
    return ops.count_op_by_program(audit(spark, sf_dir), programs(spark, sf_dir), m.CANCEL_INTERVIEW, "total_cancel")


def q_first_invite_day(spark, sf_dir):
    return ops.first_invite_day(audit(spark, sf_dir))


def q_first_day_invites(spark, sf_dir):
    return ops.first_day_invites(audit(spark, sf_dir))


def q_program_audit_base(spark, sf_dir):
    return program_audit.base(audit(spark, sf_dir), slots(spark, sf_dir), programs(spark, sf_dir))


def q_program_audit_report(spark, sf_dir):
    return program_audit.report(audit(spark, sf_dir), slots(spark, sf_dir), programs(spark, sf_dir))


# --- waitlist --------------------------------------------------------------------


def _faw(spark, sf_dir):
    return ops.first_action_waitlist(audit(spark, sf_dir))


def q_waitlist_total_invites(spark, sf_dir):
    return ops.count_op(audit(spark, sf_dir), m.INVITE, "total_invites")


def q_first_action_date(spark, sf_dir):
    return ops.first_action_date(audit(spark, sf_dir))


def q_waitlist_signups(spark, sf_dir):
    return ops.waitlist_signups(audit(spark, sf_dir))


def q_first_action_waitlist(spark, sf_dir):
    return _faw(spark, sf_dir).select(*ops.ACTOR_KEYS, m.APPLICATION_ID)


def q_scheduled_users(spark, sf_dir):
    return ops.scheduled_users(audit(spark, sf_dir))


def q_waitlisted_scheduled_users(spark, sf_dir):
    a = audit(spark, sf_dir)
    return ops.waitlisted_scheduled_users(ops.first_action_waitlist(a), ops.scheduled_users(a))


def q_app_state_completed(spark, sf_dir):
    return ops.application_states(states(spark, sf_dir), [m.STATUS_COMPLETED])


def q_app_state_canceled_or_missed(spark, sf_dir):
    return ops.application_states(states(spark, sf_dir), m.STATUS_CANCELED_OR_MISSED)


def q_app_state_withdrawn(spark, sf_dir):
    return ops.application_states(states(spark, sf_dir), [m.STATUS_WITHDRAWN])


def q_total_waitlisted(spark, sf_dir):
    return ops.count_by_group(_faw(spark, sf_dir), m.APPLICATION_ID, "total_waitlisted")


def q_total_waitlisted_to_scheduled(spark, sf_dir):
    return ops.count_by_group(
        q_waitlisted_scheduled_users(spark, sf_dir), m.CREATED_BY_USER_ID, "total_waitlisted_to_scheduled"
    )


def _to_state(codes: list[int], name: str) -> Query:
    def q(spark, sf_dir):
        return ops.waitlisted_to_state(
            _faw(spark, sf_dir), ops.application_states(states(spark, sf_dir), codes), name
        )

    return q


q_total_waitlisted_to_completed = _to_state([m.STATUS_COMPLETED], "total_waitlisted_to_completed")
q_total_waitlisted_to_canceled = _to_state(m.STATUS_CANCELED_OR_MISSED, "total_waitlisted_to_canceled")
q_total_waitlisted_to_withdrawn = _to_state([m.STATUS_WITHDRAWN], "total_waitlisted_to_withdrawn")


def q_waitlist_base(spark, sf_dir):
    return waitlist.base(audit(spark, sf_dir), states(spark, sf_dir))


def q_waitlist_report(spark, sf_dir):
    return waitlist.report(audit(spark, sf_dir), states(spark, sf_dir))


def q_waitlist_report_bucketed(spark, sf_dir):
    """R2 over the log stored in buckets of its actor keys."""
    folder = scratch_path(spark, "warehouse/audit_bucketed")
    log = colocated.BucketedLog(f"audit_bucketed_{folder.rsplit('/', 1)[1]}", f"{folder}/rest")
    colocated.write_log(audit(spark, sf_dir), log, f"{folder}/buckets", num_buckets=16)
    return colocated.waitlist_report(spark, log, states(spark, sf_dir))


# --- signup time / daily cancel ------------------------------------------------------


def q_schedule_before_waitlist(spark, sf_dir):
    return signup_time.schedule_before_waitlist(audit(spark, sf_dir))


def q_signup_time_report(spark, sf_dir):
    return signup_time.report(audit(spark, sf_dir))


def q_daily_cancel_report(spark, sf_dir):
    return daily_cancel.report(audit(spark, sf_dir))


# --- expressions ---------------------------------------------------------------------


def q_expr_nvl_zero(spark, sf_dir):
    a = audit(spark, sf_dir)
    return a.select(
        m.PROGRAM_ID,
        m.CALENDAR_SEASON_ID,
        nvl_zero(m.CREATED_BY_USER_ID).alias(m.CREATED_BY_USER_ID),
        nvl_zero(m.INTERVIEW_EVENT_ID).alias(m.INTERVIEW_EVENT_ID),
        nvl_zero(m.APPLICATION_ID).alias(m.APPLICATION_ID),
    )


def q_expr_round_div(spark, sf_dir):
    b = q_program_audit_base(spark, sf_dir)
    return b.select(
        m.PROGRAM_ID,
        m.CALENDAR_SEASON_ID,
        round_div("total_invites", "total_slots", 2).alias("invites_per_slot"),
        round_div("total_first_day_invites", "total_slots", 3).alias("first_day_invites_per_slot"),
        round_div(F.col("total_withdraw") + F.col("total_cancel"), "total_invites", 2).alias("dropouts_per_invite"),
    )


def q_expr_percent(spark, sf_dir):
    b = q_program_audit_base(spark, sf_dir)
    return b.select(
        m.PROGRAM_ID,
        m.CALENDAR_SEASON_ID,
        percent("total_withdraw", "total_invites", 1).alias("percent_withdraw"),
        percent("total_cancel", "total_invites", 2).alias("percent_cancel"),
        percent(F.col("total_slots") - F.col("total_invites"), "total_slots", 1).alias("percent_unfilled"),
    )


def q_expr_seconds_between(spark, sf_dir):
    a = audit(spark, sf_dir)
    return a.join(ops.first_action_date(a), ops.ACTOR_KEYS).select(
        *ops.ACTOR_KEYS,
        m.AUDIT_OPERATION_ID,
        seconds_between(ops.FIRST_ACTION_DATE, m.CREATED_DATE).alias("seconds_since_first_action"),
    )


QUERIES: dict[str, Query] = {
    "scan_table": q_scan_table,
    "scan_clustered": q_scan_clustered,
    "write_roundtrip": q_write_roundtrip,
    "audit_base": q_audit_base,
    "audit_with_specialty": q_audit_with_specialty,
    "invite_days": q_invite_days,
    "withdraw_ops": q_withdraw_ops,
    "cancel_ops": q_cancel_ops,
    "total_slots": q_total_slots,
    "total_invites": q_total_invites,
    "total_withdraw": q_total_withdraw,
    "total_cancel": q_total_cancel,
    "first_invite_day": q_first_invite_day,
    "first_day_invites": q_first_day_invites,
    "program_audit_base": q_program_audit_base,
    "program_audit_report": q_program_audit_report,
    "waitlist_total_invites": q_waitlist_total_invites,
    "first_action_date": q_first_action_date,
    "waitlist_signups": q_waitlist_signups,
    "first_action_waitlist": q_first_action_waitlist,
    "scheduled_users": q_scheduled_users,
    "waitlisted_scheduled_users": q_waitlisted_scheduled_users,
    "app_state_completed": q_app_state_completed,
    "app_state_canceled_or_missed": q_app_state_canceled_or_missed,
    "app_state_withdrawn": q_app_state_withdrawn,
    "total_waitlisted": q_total_waitlisted,
    "total_waitlisted_to_scheduled": q_total_waitlisted_to_scheduled,
    "total_waitlisted_to_completed": q_total_waitlisted_to_completed,
    "total_waitlisted_to_canceled": q_total_waitlisted_to_canceled,
    "total_waitlisted_to_withdrawn": q_total_waitlisted_to_withdrawn,
    "waitlist_base": q_waitlist_base,
    "waitlist_report": q_waitlist_report,
    "waitlist_report_bucketed": q_waitlist_report_bucketed,
    "schedule_before_waitlist": q_schedule_before_waitlist,
    "signup_time_report": q_signup_time_report,
    "daily_cancel_report": q_daily_cancel_report,
    "staging_full_copy": q_staging_full_copy,
    "warehouse_denormalize": q_warehouse_denormalize,
    "staging_incremental": q_staging_incremental,
    "staging_incremental_stream": q_staging_incremental_stream,
    "staging_incremental_indexed": q_staging_incremental_indexed,
    "staging_split_rows": q_staging_split_rows,
    "scan_interleaved": q_scan_interleaved,
    "daily_cancel_interleaved": q_daily_cancel_interleaved,
    "hot_users": q_hot_users,
    "write_ledger": q_write_ledger,
    "program_audit_maintained": q_program_audit_maintained,
    "daily_cancel_maintained": q_daily_cancel_maintained,
    "interview_events": q_interview_events,
    "warehouse_pipeline": q_warehouse_pipeline,
    "warehouse_waitlist": q_warehouse_waitlist,
    "warehouse_signup_time": q_warehouse_signup_time,
    "warehouse_daily_cancel": q_warehouse_daily_cancel,
    "expr_nvl_zero": q_expr_nvl_zero,
    "expr_round_div": q_expr_round_div,
    "expr_percent": q_expr_percent,
    "expr_seconds_between": q_expr_seconds_between,
}
