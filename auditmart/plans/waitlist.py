"""R2: waitlist-conversion report.

Plan (SURVEY §4 item 2):

* invitations are counted per (program, season) in a scan of their own that
  reads three columns of the invitation rows only (a few rows per task leave it);
* one aggregate per (program, season, actor) gives the first action, the
  first waitlist sign-up and a "scheduled an interview" flag; it has one consumer,
  so nothing is materialised and the report stays lazy;
* waitlist sign-ups are joined to the actors whose first action was a waitlist
  sign-up (J5) on four keys, timestamp included;
* the scheduled test (J6) is the flag from the same aggregate instead of a
  second scan plus semi join;
* application states are aggregated per application once and left-joined
  once, replacing three inner joins (J7);
* the invitation groups drive the final left join (Q7) and measures are
  nulled to 0 (E1) before the percentages (E3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as m
from ..functions import nvl_zero, percent
from ..operators import audit as ops

K = m.GROUP_KEYS

MEASURES = [
    "total_invites",
    "total_waitlisted",
    "total_waitlisted_to_scheduled",
    "total_waitlisted_to_completed",
    "total_waitlisted_to_canceled",
    "total_waitlisted_to_withdrawn",
]
BASE_COLUMNS = [*K, *MEASURES]
REPORT_COLUMNS = [
    *BASE_COLUMNS,
    "percent_waitlisted",
    "percent_waitlisted_to_scheduled",
    "percent_waitlisted_to_completed",
    "percent_waitlisted_to_canceled",
    "percent_waitlisted_to_withdrawn",
]


def waitlist_measures(faw: DataFrame, states: DataFrame) -> DataFrame:
    """A9-A13 per (program, season) from first-action waitlist rows."""
    joined = faw.join(ops.state_counts(states), m.APPLICATION_ID, "left")
    return joined.groupBy(*K).agg(
        F.count(m.APPLICATION_ID).alias("total_waitlisted"),
        F.count(F.when(F.col(ops.HAS_SCHEDULED), F.col(m.CREATED_BY_USER_ID))).alias(
            "total_waitlisted_to_scheduled"
        ),
        F.sum(F.coalesce(F.col("n_completed"), F.lit(0))).alias("total_waitlisted_to_completed"),
        F.sum(F.coalesce(F.col("n_canceled"), F.lit(0))).alias("total_waitlisted_to_canceled"),
        F.sum(F.coalesce(F.col("n_withdrawn"), F.lit(0))).alias("total_waitlisted_to_withdrawn"),
    )


def base(audit: DataFrame, states: DataFrame) -> DataFrame:
    """J3 + E1: the waitlist base table; the invitation groups decide which rows
    exist (Q7)."""
    return base_from(audit, ops.first_action_waitlist(audit), states)


def base_from(audit: DataFrame, faw: DataFrame, states: DataFrame) -> DataFrame:
    """The base table from the log and its first-action waitlist rows."""
    invites = ops.count_op(audit, m.INVITE, "total_invites")
    joined = invites.join(waitlist_measures(faw, states), K, "left")
    return joined.select(*K, *[nvl_zero(c).cast("long").alias(c) for c in MEASURES])


def report_from_base(b: DataFrame) -> DataFrame:
    wl = F.col("total_waitlisted")
    return b.select(
        *BASE_COLUMNS,
        percent(wl, "total_invites", 1).alias("percent_waitlisted"),
        percent("total_waitlisted_to_scheduled", wl, 1).alias("percent_waitlisted_to_scheduled"),
        percent("total_waitlisted_to_completed", wl, 1).alias("percent_waitlisted_to_completed"),
        percent("total_waitlisted_to_canceled", wl, 1).alias("percent_waitlisted_to_canceled"),
        percent("total_waitlisted_to_withdrawn", wl, 1).alias("percent_waitlisted_to_withdrawn"),
    )


def report(audit: DataFrame, states: DataFrame) -> DataFrame:
    """R2: the 13-column waitlist report."""
    return report_from_base(base(audit, states))
