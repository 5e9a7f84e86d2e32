"""Ordered counting within a key: "how many build rows with my key come
strictly before me?"  This is the building block for the signup-time report's
inequality joins (schedule vs. later waitlist, invitation vs. later schedule).

A plain equi-join on the key plus a residual ``<`` enumerates every pair of
rows sharing a key, which is quadratic in a hot user.  Here:

1. probe and build rows are unioned and range-partitioned on
   ``(keys, order, side)``.  Range bounds come from a sample, so a key that
   holds a third of all rows is split into many contiguous, ordered chunks;
2. a running count over ``(keys, partition)`` (a window whose groups are
   bounded by one range partition) gives the count inside the chunk;
3. a key can continue from earlier partitions only as their *last* key, so one
   summary row per partition (bounded by the partition count, hence safe to
   broadcast) carries the counts of earlier chunks forward.

Why it is exact: range partitions are contiguous, ordered intervals of
``(keys, order, side)``, and equal tuples never straddle two partitions.  For a
probe row with key ``k`` in partition ``p``, the build rows of ``k`` strictly
before it are (a) those before it inside ``p`` (the window; a probe sorts
before builds with the same ``order``, which makes ``<`` strict), and (b) all
build rows of ``k`` in earlier partitions.  An earlier partition can hold
``k`` only if ``k`` runs on into ``p``, i.e. ``k`` is the last key of that
partition and the first key of ``p``.  So (b) is zero unless ``k`` is the first
key of ``p``, and then it is the sum of the last-key build counts of the
earlier partitions whose last key is ``k``.  Ranks of build rows are the same
count taken on build rows.

Everything is DataFrame operations; no group is ever gathered in one task and
no pair of rows is materialised.  The range-partitioned union is checkpointed
(reliable checkpoint in ``spark.checkpoint.dir``) because three branches read
it; so are the scored rows when both probe counts and build ranks are wanted.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

_SIDE = "_om_side"  # 0 = probe, 1 = build: probes sort first on ties (strict <)
_PART = "_om_part"
_LOCAL = "_om_local"
_FIRST = "_om_first"
_LAST = "_om_last"
_KEY = "_om_key"
_VAL = "_om_val"
_KIND = "_om_kind"
_CARRY = "_om_carry"
_TOTAL = "_om_total"
_WEIGHT = "_om_weight"  # null on probes


def _key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def range_split(
    probe: DataFrame,
    build: DataFrame,
    keys: Sequence[str],
    order: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Step 1: probe (side 0) and build (side 1) rows unioned and
    range-partitioned on ``(keys, order, side)``, each row tagged with its range
    partition (``_om_part``), materialised in the checkpoint folder.

    The rows feed three branches (chunk counts, partition bounds, last-key
    counts).  The checkpoint gives one sampling job and one scan instead of one
    per branch, partition ids that cannot change on a retry, and a lineage cut
    that survives executor loss."""
    u = probe.withColumn(_SIDE, F.lit(0)).unionByName(
        build.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True
    )
    range_keys = [*keys, order, _SIDE]
    ranged = (
        u.repartitionByRange(num_partitions, *range_keys)
        if num_partitions
        else u.repartitionByRange(*range_keys)
    ).withColumn(_PART, F.spark_partition_id())
    shared_dir(probe.sparkSession)
    return ranged.checkpoint(eager=True)


def ordered_counts(
    probe: DataFrame,
    build: DataFrame,
    keys: Sequence[str],
    order: str,
    count_col: str = "n_before",
    rank_col: str | None = None,
    num_partitions: int | None = None,
    weight: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """For each ``probe`` row, count ``build`` rows with equal ``keys`` and a
    strictly smaller ``order`` value (``count_col``).  With ``rank_col`` the
    build rows are returned too, numbered 0.. within their key in ``order``
    (ties in arbitrary order, so tied build rows must be interchangeable).  With
    ``weight`` a build row counts that many times (a long column of ``build``).
    Rows equal in ``keys`` and ``order`` share a range partition, so callers with
    many ties aggregate them to one weighted row first.

    ``keys`` and ``order`` must be non-null on both sides (callers drop rows
    whose null key could never match an equi-join).  ``order`` is a long."""
    keys = list(keys)
    probe_cols = probe.columns
    build_cols = build.columns
    build = build.withColumn(_WEIGHT, F.lit(1).cast("long") if weight is None else F.col(weight))
    ranged = range_split(probe, build, keys, order, num_partitions)

    # (2) running count inside the chunk; groups are bounded by a partition.
    w = (
        Window.partitionBy(*keys, _PART)
        .orderBy(order, _SIDE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn(_LOCAL, F.coalesce(F.sum(_WEIGHT).over(w), F.lit(0)).cast("long"))

    # (3) one row per partition: first key, last key and the build rows of the
    # last key.  Bounded by the number of range partitions.
    bounds = ranged.groupBy(_PART).agg(
        F.min(_key_struct(keys)).alias(_FIRST), F.max(_key_struct(keys)).alias(_LAST)
    )
    last_build = (
        ranged.where(F.col(_SIDE) == 1)
        .join(F.broadcast(bounds.select(_PART, _LAST)), _PART)
        .where(_key_struct(keys) == F.col(_LAST))
        .groupBy(_PART)
        .agg(F.sum(_WEIGHT).alias(_VAL))
    )
    parts = bounds.join(F.broadcast(last_build), _PART, "left").select(
        _PART, _FIRST, _LAST, F.coalesce(F.col(_VAL), F.lit(0)).alias(_VAL)
    )
    # carry(p) = build rows of first_key(p) in earlier partitions, i.e. the sum
    # over earlier partitions whose last key equals it.  <= 2 rows/partition.
    contrib = parts.select(F.col(_LAST).alias(_KEY), _PART, _VAL, F.lit(1).alias(_KIND))
    query = parts.select(F.col(_FIRST).alias(_KEY), _PART, F.lit(0).alias(_VAL), F.lit(0).alias(_KIND))
    cw = Window.partitionBy(_KEY).orderBy(_PART, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    carry = (
        contrib.unionByName(query)
        .withColumn(_CARRY, F.sum(_VAL).over(cw))
        .where(F.col(_KIND) == 0)
        .select(_PART, F.col(_KEY).alias(_FIRST), _CARRY)
    )

    with_carry = local.join(F.broadcast(carry), _PART, "left")
    total = (
        F.col(_LOCAL)
        + F.when(_key_struct(keys) == F.col(_FIRST), F.col(_CARRY)).otherwise(F.lit(0))
    ).cast("long")

    if rank_col is None:
        return with_carry.where(F.col(_SIDE) == 0).select(*probe_cols, total.alias(count_col)), None
    # Both sides are wanted.  They prune different columns, so as two lazy
    # branches the window above would be planned and shuffled twice; the
    # scored rows are materialised once instead (one write, lineage cut).
    both = list(dict.fromkeys([*probe_cols, *build_cols]))
    scored = with_carry.select(*both, _SIDE, total.alias(_TOTAL)).checkpoint(eager=True)
    probes = scored.where(F.col(_SIDE) == 0).select(*probe_cols, F.col(_TOTAL).alias(count_col))
    ranked = scored.where(F.col(_SIDE) == 1).select(*build_cols, F.col(_TOTAL).alias(rank_col))
    return probes, ranked


def explode_range(n: Column | str, name: str, chunk: int = 4096) -> list[Column]:
    """Two generator columns producing ``name`` = 0 .. n-1, one row each, in
    two bounded steps: first one row per chunk of ``chunk`` values, then the
    values of the chunk, so no generated array holds more than
    ``max(chunk, n / chunk)`` elements.  Apply them in two selects, as
    :func:`with_range` does."""
    n = F.col(n) if isinstance(n, str) else n
    chunk_col = f"_{name}_chunk"
    n_chunks = F.ceil(n / F.lit(chunk)).cast("long")
    first = F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias(chunk_col)
    lo = F.col(chunk_col) * F.lit(chunk)
    hi = F.least(n, lo + F.lit(chunk)) - 1
    second = F.explode(F.sequence(lo, hi)).alias(name)
    return [first, second]


def with_range(df: DataFrame, n: Column | str, name: str, chunk: int = 4096) -> DataFrame:
    """Repeat every row ``n`` times with ``name`` = 0 .. n-1 (rows with
    ``n <= 0`` vanish)."""
    n = F.col(n) if isinstance(n, str) else n
    first, second = explode_range(n, name, chunk)
    chunk_col = f"_{name}_chunk"
    pos = df.where(n > 0)
    return pos.select("*", first).select("*", second).drop(chunk_col)
