"""Scalar expression helpers (E1-E5), all built from JVM-side functions so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_MICROS_PER_SECOND = 1_000_000
_MICROS_PER_DAY = 86_400 * _MICROS_PER_SECOND


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nvl_zero(c: ColumnOrName) -> Column:
    """Null becomes 0 (used on measures after a left join)."""
    return F.coalesce(_col(c), F.lit(0))


def round_div(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """``round(num / den, scale)``; a zero denominator gives null (the
    non-ANSI behaviour of the source; ANSI Spark would raise)."""
    return F.round(F.try_divide(_col(num), _col(den)), scale)


def percent(num: ColumnOrName, den: ColumnOrName, scale: int = 1) -> Column:
    """``round((num) * 100 / den, scale)``, null on a zero denominator.
    The result is not capped at 100."""
    return F.round(F.try_divide(_col(num) * F.lit(100), _col(den)), scale)


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 (long), exact for both timestamp types: an
    instant (``timestamp``) is counted in UTC, a ``timestamp_ntz`` by its own clock.
    Neither depends on the session time zone or shifts in a clock change.
    ``typeof`` is folded while planning, so one branch remains."""
    ts = _col(ts)
    own = ts.cast("timestamp_ntz")
    by_clock = (
        F.unix_date(own.cast("date")).cast("long") * F.lit(_MICROS_PER_DAY)
        + (F.hour(own) * F.lit(3600) + F.minute(own) * F.lit(60)).cast("long") * F.lit(_MICROS_PER_SECOND)
        + (F.extract(F.lit("SECOND"), own) * F.lit(_MICROS_PER_SECOND)).cast("long")
    )
    return F.when(F.typeof(ts) == "timestamp", F.unix_micros(ts.cast("timestamp"))).otherwise(by_clock)


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since 1970-01-01, rounded down.  The microsecond count is
    exact; removing the sub-second remainder first makes the division exact as
    well."""
    micros = epoch_micros(ts)
    whole = micros - F.pmod(micros, F.lit(_MICROS_PER_SECOND))
    return (whole / F.lit(_MICROS_PER_SECOND)).cast("long")


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``unix_timestamp(end) - unix_timestamp(start)`` as a long."""
    return epoch_seconds(end) - epoch_seconds(start)
