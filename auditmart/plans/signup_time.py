"""Time from invitation to interview sign-up.

The source joins schedules to waitlist sign-ups on (user, event) keeping
"waitlisted later or at an unknown time" (J8, F5), then joins invitations on
(user, program, season) keeping "invited earlier" (J9, F6).  The result is a
bag: one row per (invitation, schedule, waitlist) triple (Q5).

One plan at every size, over two disjoint sets of users.  Every join key holds the
user, so a user's numbers of invitations, schedules and waitlists bound the pairs of
all its keys.  One scan of the log before the joins finds the users with many rows by a
frequency sketch (:mod:`auditmart.operators.frequent`), and only these are counted
exactly; a user with more than ``MAX_PAIRS_PER_USER`` possible pairs is *hot*.

Cold users take the source's equi-joins with residual inequalities, the
schedule-waitlist pairs counted per schedule before the second join.

Hot users never enumerate candidate pairs:

* rows that agree in key and time are interchangeable, so each side is first
  aggregated to (key, time) with a count; no ties remain and partial aggregation
  combines them map-side;
* pass A, :func:`ordered_counts` on (user, event): for every schedule time the
  number of waitlist rows strictly later (an undated waitlist counts for every
  schedule);
* pass B, :func:`ordered_counts` on (user, program, season): for every schedule
  time the number of earlier invitation times, for every invitation time its rank;
* a schedule time with ``c`` earlier invitation times pairs with ranks 0 .. c-1,
  fetched in blocks of ``RANK_BLOCK`` ranks by an equi-join on (user, program,
  season, block, salt) with the residual ``rank < c``.  A pair stands for (schedule
  rows x waitlists x invitation rows) output rows, generated last, in chunks that
  are dealt out over all tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as m
from ..functions import epoch_micros, seconds_between
from ..operators.frequent import heavy_items
from ..operators.ordered import ordered_counts, with_range
from ..sources.tables import scratch_copy

INVITE_DATE = "invite_date"
SCHEDULE_DATE = "schedule_date"
WAITLIST_DATE = "waitlist_date"
N_WAITLISTS = "n_waitlists"
N_ROWS = "n_rows"
N_INVITES_BEFORE = "n_invites_before"
INVITE_RANK = "invite_rank"
SIGNUP_TIME = "signup_time"
_ORDER = "_order"
_BLOCK = "_rank_block"
_SALT = "_salt"
_SALTS = "_salts"

# --- fixed values ----------------------------------------------------------------
MAX_PAIRS_PER_USER = 1_000_000  # candidate pairs of a user one task may enumerate
ROWS_PER_PAIR = 100  # output rows a task may write for a cold user, per pair allowed
RANK_BLOCK = 256  # invitation ranks fetched per probe row of a hot key
REQUESTS_PER_SALT = 100_000  # requests for one (key, block) that one task serves
CHUNK = 4096  # output rows of one pair that one task generates at a time

_LONG_MIN = -(2**63)
# Pass A orders by descending time: a waitlist sign-up with an unknown time sorts
# before everything (counts for every schedule); a schedule with an unknown time
# sorts right after it (only unknown-time waitlists count for it).
_WAITLIST_NULL_ORDER = _LONG_MIN
_SCHEDULE_NULL_ORDER = _LONG_MIN + 1

REPORT_COLUMNS = [m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.USER_ID, SIGNUP_TIME]
SW_COLUMNS = [m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.USER_ID, SCHEDULE_DATE, N_WAITLISTS]


def _op() -> Column:
    return F.col(m.AUDIT_OPERATION_ID)


def _user_event() -> Column:
    return F.col(m.USER_ID).isNotNull() & F.col(m.INTERVIEW_EVENT_ID).isNotNull()


def _group_keys() -> Column:
    return F.col(m.PROGRAM_ID).isNotNull() & F.col(m.CALENDAR_SEASON_ID).isNotNull()


def _schedules(audit: DataFrame) -> DataFrame:
    """Interview sign-ups that can meet a waitlist row (user and event set)."""
    return audit.where((_op() == m.SIGNUP_INTERVIEW) & _user_event()).select(
        m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.USER_ID, m.INTERVIEW_EVENT_ID,
        F.col(m.CREATED_DATE).alias(SCHEDULE_DATE),
    )


def _waitlists(audit: DataFrame) -> DataFrame:
    return audit.where((_op() == m.SIGNUP_WAITLIST) & _user_event()).select(
        m.USER_ID, m.INTERVIEW_EVENT_ID, F.col(m.CREATED_DATE).alias(WAITLIST_DATE)
    )


def _invites(audit: DataFrame) -> DataFrame:
    """Dated invitations that can meet a schedule (all join keys set)."""
    return audit.where(
        (_op() == m.INVITE) & _group_keys() & F.col(m.USER_ID).isNotNull() & F.col(m.CREATED_DATE).isNotNull()
    ).select(m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.USER_ID, F.col(m.CREATED_DATE).alias(INVITE_DATE))


# --- None if hot is None else cold users -----------------------------------------------------------

USER_EVENT = [m.USER_ID, m.INTERVIEW_EVENT_ID]
USER_GROUP = [m.USER_ID, m.PROGRAM_ID, m.CALENDAR_SEASON_ID]


def hot_users(audit: DataFrame, max_pairs: float, invitations: bool = True) -> DataFrame:
    """(user_id) of the users that could make more than ``max_pairs`` schedule-waitlist
    or invitation-schedule pairs, or ``ROWS_PER_PAIR`` times as many output rows;
    without ``invitations`` only the first count.

    n rows make at most (n/2)^2 pairs and (n/3)^3 triples, so one sketch of rows per user
    finds all candidates in one scan.  Only where there are any, a second scan counts
    their operations exactly.  Counts multiply as doubles, so no product overflows."""
    limit = F.lit(float(max_pairs))
    sides = {"schedules": (_op() == m.SIGNUP_INTERVIEW) & _user_event(), "waitlists": (_op() == m.SIGNUP_WAITLIST) & _user_event()}
    if invitations:
        sides["invites"] = (_op() == m.INVITE) & _group_keys() & F.col(m.CREATED_DATE).isNotNull()

    def possible(n: dict[str, Column]) -> Column:
        rows = n["rows"].cast("double")
        many = rows * rows / 4 > limit
        return many | (rows * rows * rows / 27 > limit * ROWS_PER_PAIR) if invitations else many

    rows = audit.where(reduce(or_, sides.values()))
    candidates = heavy_items(rows, m.USER_ID, {"rows": F.lit(True)}, possible)
    if candidates.isEmpty():
        return candidates
    counts = rows.join(candidates, m.USER_ID, "left_semi").groupBy(m.USER_ID).agg(
        *(F.count(F.when(side, 1)).cast("double").alias(name) for name, side in sides.items())
    )
    many = F.col("schedules") * F.col("waitlists") > limit
    if invitations:
        invited = F.col("invites") * F.col("schedules")
        many = many | (invited > limit) | (invited * F.col("waitlists") > limit * ROWS_PER_PAIR)
    return scratch_copy(counts.where(many).select(m.USER_ID), "hot_users")


def _split(audit: DataFrame, max_pairs: float, invitations: bool = True) -> tuple[DataFrame | None, DataFrame | None]:
    """The log of the None if cold is None else of the hot users; None where there is none.  Without a
    bound all users are cold, with a negative one all are hot."""
    if max_pairs == float("inf"):
        return audit, None
    if max_pairs < 0:
        return None, audit
    hot = hot_users(audit, max_pairs, invitations)
    if hot.isEmpty():
        return audit, None
    return audit.join(hot, m.USER_ID, "left_anti"), audit.join(hot, m.USER_ID, "left_semi")


def _union(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    if cold is None or hot is None:
        return hot if cold is None else cold
    return cold.unionByName(hot)


# --- J8 + F5: schedules with their waitlist multiplicity -----------------------------


def _desc_time(col: str, null_order: int):
    ts = F.col(col)
    return F.when(ts.isNull(), F.lit(null_order)).otherwise(-epoch_micros(ts)).cast("long")


def _sw_pairs(schedules: DataFrame, waitlists: DataFrame) -> DataFrame:
    """J8 + F5 as the source defines it: a row per (schedule, waitlist) pair of
    the same user and event with the waitlist later or undated."""
    later = F.col(WAITLIST_DATE).isNull() | (F.col(WAITLIST_DATE) > F.col(SCHEDULE_DATE))
    return schedules.join(waitlists, USER_EVENT).where(later).select(
        m.PROGRAM_ID, m.CALENDAR_SEASON_ID, m.USER_ID, SCHEDULE_DATE
    )


def _sw_ordered(schedules: DataFrame, waitlists: DataFrame, num_partitions: int | None) -> DataFrame:
    """The same pairs as counts per (program, season, user, schedule time)."""
    probes = schedules.groupBy(*schedules.columns).agg(F.count(F.lit(1)).alias("_schedules")).withColumn(
        _ORDER, _desc_time(SCHEDULE_DATE, _SCHEDULE_NULL_ORDER)
    )
    builds = waitlists.groupBy(*USER_EVENT, _desc_time(WAITLIST_DATE, _WAITLIST_NULL_ORDER).alias(_ORDER)).agg(
        F.count(F.lit(1)).alias("_waitlists")
    )
    counted, _ = ordered_counts(
        probes, builds, USER_EVENT, _ORDER, count_col="_later", weight="_waitlists", num_partitions=num_partitions
    )
    pairs = (F.col("_schedules") * F.col("_later")).alias(N_WAITLISTS)
    return counted.where(F.col("_later") > 0).select(*SW_COLUMNS[:-1], pairs)


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*SW_COLUMNS[:-1]).agg(F.count(F.lit(1)).alias(N_WAITLISTS)).select(*SW_COLUMNS)


def _sw_cold(audit: DataFrame) -> DataFrame:
    return _counted(_sw_pairs(_schedules(audit), _waitlists(audit)))


def _sw_hot(audit: DataFrame, num_partitions: int | None) -> DataFrame:
    return _sw_ordered(_schedules(audit), _waitlists(audit), num_partitions)


def schedules_with_waitlists(
    audit: DataFrame, max_pairs: float = MAX_PAIRS_PER_USER, num_partitions: int | None = None
) -> DataFrame:
    """J8 + F5 as counts: (program, season, user, schedule_date) with the number of
    matching (schedule, waitlist) pairs.  A bag after expanding ``n_waitlists``."""
    cold, hot = _split(audit, max_pairs, invitations=False)
    return _union(None if cold is None else _sw_cold(cold), None if hot is None else _sw_hot(hot, num_partitions))


def schedule_before_waitlist(
    audit: DataFrame, max_pairs: float = MAX_PAIRS_PER_USER, num_partitions: int | None = None
) -> DataFrame:
    """J8 output as the source materialises it: one (program, season, user,
    schedule_date) row per matching waitlist sign-up."""
    cold, hot = _split(audit, max_pairs, invitations=False)
    return _union(
        None if cold is None else _sw_pairs(_schedules(cold), _waitlists(cold)),
        None if hot is None else _copies(_sw_hot(hot, num_partitions), F.col(N_WAITLISTS)).select(*SW_COLUMNS[:-1]),
    )


def _copies(df: DataFrame, n: Column) -> DataFrame:
    """Every row ``n`` times.  Rows are first split into chunks of ``CHUNK``
    copies, and the chunks are dealt out over all tasks before they are filled."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = with_range(df.withColumn("_n", n), F.ceil(F.col("_n") / F.lit(CHUNK)).cast("long"), "_chunk").repartition(tasks)
    size = F.least(F.lit(CHUNK).cast("long"), F.col("_n") - F.col("_chunk") * F.lit(CHUNK))
    return with_range(chunks, size, "_copy").select(*df.columns)


# --- J9 + F6 + E4: the report ---------------------------------------------------------


def _result(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        m.PROGRAM_ID,
        m.CALENDAR_SEASON_ID,
        m.USER_ID,
        seconds_between(INVITE_DATE, SCHEDULE_DATE).alias(SIGNUP_TIME),
    )


def _report_cold(invites: DataFrame, sw: DataFrame) -> DataFrame:
    """J9 + F6 on schedules carrying their waitlist multiplicity, then one output
    row per multiplicity."""
    pairs = invites.join(sw, USER_GROUP).where(F.col(INVITE_DATE) < F.col(SCHEDULE_DATE))
    return _result(with_range(pairs, N_WAITLISTS, "_copy"))


def _report_hot(invites: DataFrame, sw: DataFrame, num_partitions: int | None) -> DataFrame:
    probes = sw.groupBy(*USER_GROUP, SCHEDULE_DATE).agg(F.sum(N_WAITLISTS).alias(N_WAITLISTS)).withColumn(
        _ORDER, epoch_micros(SCHEDULE_DATE)
    )
    builds = invites.groupBy(*USER_GROUP, INVITE_DATE).agg(F.count(F.lit(1)).alias(N_ROWS)).withColumn(
        _ORDER, epoch_micros(INVITE_DATE)
    )
    counted, ranked = ordered_counts(
        probes, builds, USER_GROUP, _ORDER, count_col=N_INVITES_BEFORE, rank_col=INVITE_RANK,
        num_partitions=num_partitions,
    )
    # A schedule time pairs with the invitation times ranked 0 .. c-1 of its key,
    # fetched in blocks of RANK_BLOCK ranks: one probe row per block, an equi-join on
    # (key, block, salt) and the residual rank < c.  Only input-sized rows cross the
    # shuffle, and fewer than RANK_BLOCK candidates per schedule time are discarded.
    c = F.col(N_INVITES_BEFORE)
    n_blocks = F.ceil(c / F.lit(RANK_BLOCK)).cast("long")
    probe_blocks = with_range(counted.where(c > 0), n_blocks, _BLOCK)
    invite_blocks = ranked.select(
        *USER_GROUP, INVITE_RANK, INVITE_DATE, N_ROWS, F.floor(F.col(INVITE_RANK) / F.lit(RANK_BLOCK)).cast("long").alias(_BLOCK)
    )
    pairs = _block_join(probe_blocks, invite_blocks, USER_GROUP).where(F.col(INVITE_RANK) < c)
    return _result(_copies(pairs, F.col(N_WAITLISTS) * F.col(N_ROWS)))


def _block_join(probe_blocks: DataFrame, invite_blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Join schedule block requests to invitation blocks on (key, block).

    All schedules of a hot user request its block 0.  The requests of a (key,
    block) are counted (partial aggregation) and spread by a hash of the request
    over one salt per ``REQUESTS_PER_SALT`` of them; a block (at most ``RANK_BLOCK``
    rows) is copied once per salt.  Requests differ in their time, so the salts
    fill evenly.  The counts join like any table; Spark picks the join by size."""
    join_keys = [*keys, _BLOCK]
    salts = probe_blocks.groupBy(*join_keys).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(REQUESTS_PER_SALT)).cast("int").alias(_SALTS)
    )
    probes = probe_blocks.join(salts, join_keys).withColumn(
        _SALT, F.pmod(F.xxhash64(*[F.col(c) for c in probe_blocks.columns]), F.col(_SALTS)).cast("int")
    )
    invites = invite_blocks.join(salts, join_keys).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.col(_SALTS) - 1))
    )
    return probes.drop(_SALTS).join(invites.drop(_SALTS), [*join_keys, _SALT]).drop(_SALT)


def report(audit: DataFrame, max_pairs: float = MAX_PAIRS_PER_USER, num_partitions: int | None = None) -> DataFrame:
    """(program, season, user, signup_time seconds), a bag.  The sketch's scan runs
    when the report is built; without hot users the rest is lazy."""
    cold, hot = _split(audit, max_pairs)
    dated = _group_keys() & F.col(SCHEDULE_DATE).isNotNull()
    return _union(
        None if cold is None else _report_cold(_invites(cold), _sw_cold(cold).where(dated)),
        None if hot is None else _report_hot(_invites(hot), _sw_hot(hot, num_partitions).where(dated), num_partitions),
    )
