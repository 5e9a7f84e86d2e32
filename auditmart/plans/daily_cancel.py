"""Daily cancellations per (program, season, day).

One filtered scan (``PushedFilters: EqualTo(audit_operation_id, 5)``), a date
cast and a grouped count; the hash aggregate combines map-side.  The source
calls it a "rate" but outputs a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audit import daily_cancels

REPORT_COLUMNS = ["program_id", "calendar_season_id", "created_date", "daily_cancel"]


def report(audit: DataFrame) -> DataFrame:
    return daily_cancels(audit)


def report_from_daily(per_day: DataFrame) -> DataFrame:
    """R4 from the program-audit day table (``program_audit.daily_measures``):
    the (program, season, day) groups that have cancellation rows, counting
    their actors.  Lets one scan of the log serve R1 and R4."""
    return per_day.where(F.col("cancel_rows") > 0).select(
        "program_id",
        "calendar_season_id",
        F.col("day").alias("created_date"),
        F.col("cancel_actors").alias("daily_cancel"),
    )
