"""Report jobs: compute a report and write it to its report table, the way the
source's entry methods do (default mode ``append``, SURVEY Q10).

A :class:`Warehouse` says where the logical tables live; any ``TableRef``
format works (Parquet paths, catalog tables, JDBC).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import model as m
from .operators.audit import audit_base
from .plans import daily_cancel, program_audit, signup_time, waitlist
from .sources import driver_tables as dt
from .sources.file_index import index_files, interleave
from .sources.staging import denormalize, stage_tables
from .sources.tables import TableRef, read_table, shared_dir, write_table


@dataclass(frozen=True)
class Warehouse:
    """Locations of the input tables and of the report tables."""

    audit: TableRef | str
    slots: TableRef | str
    programs: TableRef | str  # withdrawals and cancellations count once per program row (Q19)
    application_states: TableRef | str
    program_audit_report: TableRef | str
    waitlist_report: TableRef | str
    signup_time_report: TableRef | str
    daily_cancel_report: TableRef | str


def _audit(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return audit_base(read_table(spark, wh.audit))


def load_program_audit_report(spark: SparkSession, wh: Warehouse, mode: str = "append") -> DataFrame:
    """R1 computed and written; returns the report as written."""
    slots = m.conform(read_table(spark, wh.slots), m.SLOT_SCHEMA)
    programs = m.conform(read_table(spark, wh.programs), m.PROGRAM_SCHEMA)
    report = program_audit.report(_audit(spark, wh), slots, programs)
    write_table(report, wh.program_audit_report, mode)
    return report


def load_waitlist_report(spark: SparkSession, wh: Warehouse, mode: str = "append") -> DataFrame:
    states = m.conform(read_table(spark, wh.application_states), m.APPLICATION_STATE_SCHEMA)
    report = waitlist.report(_audit(spark, wh), states)
    write_table(report, wh.waitlist_report, mode)
    return report


def load_signup_time_report(spark: SparkSession, wh: Warehouse, mode: str = "append") -> DataFrame:
    report = signup_time.report(_audit(spark, wh))
    write_table(report, wh.signup_time_report, mode)
    return report


def load_daily_cancel_report(spark: SparkSession, wh: Warehouse, mode: str = "append") -> DataFrame:
    report = daily_cancel.report(_audit(spark, wh))
    write_table(report, wh.daily_cancel_report, mode)
    return report


def run_all(spark: SparkSession, wh: Warehouse, mode: str = "append", parallel_jobs: int = 2) -> None:
    """All four report jobs.  R1 and R4 share one scan of the log: the
    (program, season, day) table both aggregate from is computed once and
    checkpointed (it is small: groups times days), then each report is
    derived from it.  The report writes are independent jobs; up to
    ``parallel_jobs`` are submitted at once from driver threads.  Nothing but
    job handles passes through the driver."""
    from concurrent.futures import ThreadPoolExecutor

    audit = _audit(spark, wh)
    shared_dir(spark)
    per_day = program_audit.daily_measures(audit).checkpoint(eager=True)
    slots = m.conform(read_table(spark, wh.slots), m.SLOT_SCHEMA)
    programs = m.conform(read_table(spark, wh.programs), m.PROGRAM_SCHEMA)
    tasks = [
        lambda: write_table(program_audit.report(audit, slots, programs, per_day=per_day), wh.program_audit_report, mode),
        lambda: write_table(daily_cancel.report_from_daily(per_day), wh.daily_cancel_report, mode),
        lambda: load_waitlist_report(spark, wh, mode),
        lambda: load_signup_time_report(spark, wh, mode),
    ]
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        for future in [pool.submit(t) for t in tasks]:
            future.result()  # re-raise the first failure


# --- staging -> warehouse -> report -----------------------------------------------------

SOURCE_TABLES = ("events", "supplier", "customer", "nation")
AUDIT_LAYOUT = [m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.AUDIT_OPERATION_ID, m.CREATED_DATE]


def build_warehouse(spark: SparkSession, staged: str, target: str) -> Warehouse:
    """Store the warehouse tables built from a staged database: the audit log
    with its program's specialty carried onto it (W1), interleaved by program, season,
    operation and time so that a filter on any of them prunes its files, and the
    dimensions."""
    programs = m.conform(dt.program_fact(spark, staged), m.PROGRAM_SCHEMA)
    specialties = programs.dropDuplicates([m.PROGRAM_ID])  # a carried parent must be unique
    audit = denormalize(
        audit_base(dt.audit_dim(spark, staged)), specialties, m.PROGRAM_ID, m.PROGRAM_ID, [m.SPECIALTY_ID]
    )
    tables = {
        "audit_dim": interleave(audit, AUDIT_LAYOUT),
        "track_tier_slot_dim": m.conform(dt.track_tier_slot_dim(spark, staged), m.SLOT_SCHEMA),
        "application_state_dim": m.conform(dt.application_state_dim(spark, staged), m.APPLICATION_STATE_SCHEMA),
        "program_fact": programs,
    }
    for name, df in tables.items():
        write_table(df, f"{target}/{name}", mode="overwrite")
    index_files(spark, f"{target}/audit_dim", AUDIT_LAYOUT)
    reports = {r: f"{target}/report/{r}" for r in ("program_audit", "waitlist", "signup_time", "daily_cancel")}
    return Warehouse(
        audit=f"{target}/audit_dim",
        slots=f"{target}/track_tier_slot_dim",
        programs=f"{target}/program_fact",
        application_states=f"{target}/application_state_dim",
        **{f"{r}_report": path for r, path in reports.items()},
    )


def staged_warehouse(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Stage the source tables under ``root`` (W0) and build the warehouse from the
    staged copies (W1)."""
    staged = f"{root}/staging"
    stage_tables(spark, {f"{t}.parquet": dt.table_path(sf_dir, t) for t in SOURCE_TABLES}, staged)
    return build_warehouse(spark, staged, f"{root}/warehouse")


def pipeline_report(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The whole chain: stage, build the warehouse, and compute R1 from the stored
    tables."""
    wh = staged_warehouse(spark, sf_dir, root)
    slots = m.conform(read_table(spark, wh.slots), m.SLOT_SCHEMA)
    programs = m.conform(read_table(spark, wh.programs), m.PROGRAM_SCHEMA)
    return program_audit.report(_audit(spark, wh), slots, programs)


def pipeline_reports(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """The whole chain with every report computed from the stored tables and
    written; says where."""
    wh = staged_warehouse(spark, sf_dir, root)
    run_all(spark, wh)
    return wh
