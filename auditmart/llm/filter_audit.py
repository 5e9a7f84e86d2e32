"""Operator 12, filter interaction audit: what each of several filters removes
under every order in which they could be applied.

A document is reduced to the set of filters it fails, a bit mask; a part (source)
is then a count per mask.  Orders are paths through the lattice of filter
subsets: an edge (S, f) applies f after the filters of S.  Counting paths forward to
S and backward from S + f says how many orders use the edge, so each edge is
measured once: weighted by its paths its removals give the Shapley totals, and the
steps of a single order are read off the same edges.

Only the reduction to masks grows with the data.  Its shuffled rows hold no text,
and a text shared by a third of all rows collapses map-side to a row per part."""

from __future__ import annotations

from itertools import permutations
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty

# --- fixed values: the contract's filters -------------------------------------------
LETTERS = "ABCDE"
MIN_WORDS = 200  # A: fewer words
MIN_DISTINCT_PERCENT = 50  # B: fewer distinct words in a hundred
MAX_CAPITAL_PERCENT = 2  # C: more capital letters in a hundred code points
MARKS = "[#$%&*|]"  # D: holds any of them
SPACE = r"[\x20\x09-\x0D]+"  # what separates words


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D on a non-null text."""
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    return [
        n < MIN_WORDS,
        distinct * F.lit(100).cast("long") < n * F.lit(MIN_DISTINCT_PERCENT).cast("long"),
        F.regexp_count(text, F.lit("[A-Z]")) * F.lit(100).cast("long")
        > F.length(text) * F.lit(MAX_CAPITAL_PERCENT).cast("long"),
        text.rlike(MARKS),
    ]


def _mask(failures: Sequence[Column]) -> Column:
    mask = F.lit(0)
    for i, fails in enumerate(failures):
        mask = mask + F.when(fails, F.lit(1 << i)).otherwise(F.lit(0))
    return mask.cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per source and set of failed filters
    (bit i of ``mask``: filter ``LETTERS[i]``), and how many of them are labelled
    quality 1 and toxic 1.

    A null text is empty, a null source the part ''.  E fails where a smaller
    doc_id has the same text; rows that share the least doc_id all pass, and a
    null doc_id is neither smaller nor larger.  A document is good or toxic if any
    of its label rows says so; null ids have no label.  Extra columns are ignored;
    an empty table gives no rows."""
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
        _mask(text_failures(text)).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = rows.join(flags, "doc_id", "left").select(
        "doc_id", "part", "key", "mask", "n", *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic"))
    )
    # a group holds one row per doc_id, so the least id's count is that of its struct
    known = F.col("doc_id").isNotNull()
    texts = rows.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, F.lit(0)).otherwise(F.col("n"))).alias("unnamed"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    held = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(F.lit(0))
    passing = (F.col("unnamed") + held).alias("passing")
    both = texts.select("part", "mask", "good", "toxic", "n", passing).select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
                F.struct(
                    F.col("mask").bitwiseOR(F.lit(1 << LETTERS.index("E"))).alias("mask"),
                    (F.col("n") - F.col("passing")).alias("n"),
                ),
            )
        ),
    )
    return both.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("toxic"),
    )


def lattice(n: int) -> list[tuple[int, int, int]]:
    """Edges (S, f, orders) of the lattice of subsets of n filters, as bit masks:
    ``orders`` of the n! orders apply filter bit f right after exactly the filters
    of S.  Paths are counted forward from the empty set and backward from the full
    one."""
    full = (1 << n) - 1
    bits = [1 << i for i in range(n)]
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for s in range(full + 1):  # a subset is a smaller number than its supersets
        for f in bits:
            if not s & f:
                forward[s | f] += forward[s]
    for s in range(full, -1, -1):
        for f in bits:
            if not s & f:
                backward[s] += backward[s | f]
    return [(s, f, forward[s] * backward[s | f]) for s in range(full + 1) for f in bits if not s & f]


def edge_measures(counts: DataFrame, n: int) -> DataFrame:
    """Every part's documents at every lattice edge (before, filter): kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, and shapley, the filter's
    removals over all orders.  ``counts``: (part, mask, n, good, toxic), at most
    2^n rows a part."""
    edges = F.array(*(
        F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("orders"))
        for s, f, w in lattice(n)
    ))
    rows = counts.select("part", "mask", "n", "good", "toxic", F.inline(edges))
    mask, before, own = F.col("mask"), F.col("before"), F.col("filter")
    fails = mask.bitwiseAND(own) != 0
    present = mask.bitwiseAND(before) == 0

    def total(condition: Column, value: str, name: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long").alias(name)

    measured = rows.groupBy("part", "before", "filter", "orders").agg(
        total(present & ~fails, "n", "kept"),
        total(present & fails, "n", "removed"),
        total(~present & fails, "n", "redundant"),
        total(mask == own, "n", "unique_fails"),
        total(present & fails, "good", "good_lost"),
        total(present & fails, "toxic", "toxic_lost"),
    )
    every = Window.partitionBy("part", "filter")
    return measured.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(every)).drop("orders")


def order_steps(letters: str) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, before, filter) of all orders: n! x n rows."""
    out = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << letters.index(letter)
            out.append(("".join(order), step, before, own))
            before |= own
    return out


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every part under every order of the filters, one row a step: part,
    filter_order, step and the measures of :func:`edge_measures`.  ``counts`` as by
    :func:`mask_counts`, for any filters of one letter each; the table of
    orders (n! x n rows) is the only broadcast, so n is at most 7."""
    if len(letters) > 7:
        raise ValueError("at most 7 filters: the result lists all their orders")
    steps = counts.sparkSession.createDataFrame(
        order_steps(letters), "filter_order string, step int, before int, filter int"
    )
    return edge_measures(counts, len(letters)).join(F.broadcast(steps), ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


# The same audit from its definition: every order, every step, all documents.
ORACLE_SQL = r"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, part, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * capitals > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL
), letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, s AS step, filter_order[s] AS own, filter_order[1:s - 1] AS before
  FROM orders, generate_series(1, 5) t(s)
), r AS (
  SELECT part, filter_order, step, own,
         contains(failed, own) AS fails,
         before <> '' AND regexp_matches(failed, '[' || before || '_]') AS gone,
         failed, n, good, toxic
  FROM c, steps
), m AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (failed = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM m
"""
