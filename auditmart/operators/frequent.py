"""Frequent items by a mergeable sketch, with nothing missed.

A join on a skewed key needs to know its heavy keys before it runs.  Counting every key
shuffles every key.  Spark's frequent-items sketch (a Misra-Gries summary: a bounded
number of counters, merged map-side) answers in one scan: an item that it lists has at
most the count it states, an item that it does not list has at most a share of
the rows that its size fixes.  Items are dealt over buckets by hash, one sketch per
bucket and side, so the counters grow with the cluster and no task merges them all.

The bounds make the answer safe: an item may be called heavy that is not, never
the reverse.  Where a bucket has so many rows that the bound for unlisted items is itself
heavy, that bucket's items are counted exactly."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import scratch_copy

SKETCH_ITEMS = 65_536  # items that one sketch follows

Heavy = Callable[[dict[str, Column]], Column]  # upper bounds of an item's rows per side -> heavy?


def unlisted_bound(rows: Column, items: int = SKETCH_ITEMS) -> Column:
    """The most rows that an item can have of ``rows`` without being listed.  The sketch
    keeps a power-of-two table that is at most three quarters full, its error is
    3.5 / table size of the rows, and it lists items beyond twice its error."""
    table = 1
    while table * 3 < items * 4:
        table *= 2
    return F.floor(rows * F.lit(7.0 / table)).cast("long")


def heavy_items(
    rows: DataFrame,
    item: str,
    sides: dict[str, Column],
    heavy: Heavy,
    items: int = SKETCH_ITEMS,
    buckets: int | None = None,
) -> DataFrame:
    """The values of ``item`` (a long column, nulls left out) for which ``heavy``
    holds, given how many rows of each side have them; ``heavy`` must grow with the
    counts.  All values whose true counts are heavy are there, and such values whose
    counts the sketch cannot tell from heavy ones.  Written: (item).

    One scan of ``rows``; a second one over the buckets that are too full for their
    sketch, where there are any (see the module)."""
    spark = rows.sparkSession
    n_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(sides)
    tagged = rows.where(F.col(item).isNotNull()).select(
        F.col(item).cast("long").alias("_item"),
        F.pmod(F.xxhash64(F.col(item).cast("long")), F.lit(n_buckets)).cast("int").alias("_bucket"),
        *(F.coalesce(side, F.lit(False)).alias(f"_is_{n}") for n, side in sides.items()),
    )
    sketches = tagged.groupBy("_bucket").agg(*(
        a
        for n in names
        for a in (
            F.expr(f"approx_top_k_accumulate(_item, {items}) FILTER (WHERE _is_{n})").alias(f"_sketch_{n}"),
            F.count(F.when(F.col(f"_is_{n}"), 1)).alias(f"_rows_{n}"),
        )
    ))
    rest = {n: unlisted_bound(F.col(f"_rows_{n}"), items) for n in names}
    zero = F.lit(0).cast("long")

    def listed(n: str) -> Column:
        found = F.expr(f"approx_top_k_estimate(_sketch_{n}, {items})")
        return F.transform(found, lambda x: F.struct(
            x["item"].alias("_item"), *((x["count"].cast("long") if m == n else zero).alias(f"_n_{m}") for m in names)
        ))

    nothing = F.array(F.struct(F.lit(None).cast("long").alias("_item"), *(zero.alias(f"_n_{m}") for m in names)))
    bounded = sketches.withColumn("_weak", heavy(rest)).select(
        "_bucket", "_weak", *(rest[n].alias(f"_rest_{n}") for n in names),
        F.explode(F.when(F.col("_weak"), nothing).otherwise(F.concat(*(listed(n) for n in names)))).alias("_entry"),
    )
    counts = bounded.groupBy("_bucket", "_weak", *(f"_rest_{n}" for n in names), F.col("_entry._item").alias(item)).agg(
        *(F.max(f"_entry._n_{n}").alias(f"_n_{n}") for n in names)
    )
    bounds = {n: F.greatest(F.col(f"_n_{n}"), F.col(f"_rest_{n}")) for n in names}
    found = scratch_copy(counts.where(F.col("_weak") | heavy(bounds)).select(item, "_bucket", "_weak"), "heavy_items")
    weak = found.where("_weak").select("_bucket")
    known = found.where("NOT _weak").select(item)
    if weak.isEmpty():
        return known
    exact = tagged.join(weak, "_bucket", "left_semi").groupBy(F.col("_item").alias(item)).agg(
        *(F.count(F.when(F.col(f"_is_{n}"), 1)).alias(f"_n_{n}") for n in names)
    )
    return scratch_copy(known.unionByName(exact.where(heavy({n: F.col(f"_n_{n}") for n in names})).select(item)), "heavy_items")
