"""Operator 7, URL filters: rules, then host word segmentation with naive Bayes.

A URL is split into host and path; the longest fitting rule decides.  Other URLs
are judged by a multinomial naive Bayes over the words of host and path, where
concatenated names are split into words by a unigram Viterbi search.  The unigram
counts come from the visible text of all pages on top of a public vocabulary's
whole words (host names would teach the very concatenations that are to be split).

Every join is hinted to the shuffle plan.  Both its sides grow with the input, and Spark
would judge them by the size of the compressed files they are read from: rows made from
those (the substrings of a name, the parts of a URL) are many times larger, and what was
taken for a small table would not fit the driver."""

from __future__ import annotations

import json
import math
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, prepare
from .tokens import vocabulary_path

# --- fixed values ---------------------------------------------------------------------
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# seed words of unwanted hosts: they label the pages naive Bayes is trained on
UNWANTED = (
    "spam pills cheap casino bets bet adult porn xxx viagra poker lottery jackpot gambling ads track tracker clickbait "
    "warez torrent malware phish payday loans escort"
).split()

LONGEST_WORD = 24
LONGEST_LABEL = 63  # a host label's length limit; longer parts stay whole words
SMOOTHING = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased;
    empty for null or no ``://``."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is ``host`` or a parent domain of it and
    whose path starts ``path``; null if none fits."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + prefix)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("string")


def _parts(column: str) -> Column:
    return F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}]+")


def unigrams(pages: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(word, n): how often each run of letters occurs in the visible text of all
    pages, plus one for every whole word of the public vocabulary file."""
    spark = pages.sparkSession
    with open(vocabulary or vocabulary_path(), encoding="utf-8") as f:
        known = json.load(f)["model"]["vocab"]
    base = spark.createDataFrame(
        [(w[:-4], 1) for w in known if w.endswith("</w>") and w[:-4].isalpha() and 3 <= len(w) - 4 <= LONGEST_WORD],
        "word string, n long",
    )
    visible = F.regexp_replace(F.col("html"), r"(?s)<(script|style).*?</\1>|<[^>]*>|&\w+;", " ")
    words = pages.select(
        F.explode(F.split(F.lower(visible), r"[^\p{L}]+")).alias("word")
    ).where(F.length("word").between(2, LONGEST_WORD))
    return (
        words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).union(base)
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words): every distinct ``name`` split into its likeliest words.

    The substrings of the names are joined to the unigram counts by a shuffle, so
    neither is ever broadcast; the Viterbi search then sees only one name's own
    substrings.  Unknown stretches cost more the longer they are."""
    total = counts.agg(F.sum("n").cast("double")).first()[0] or 1.0
    distinct = materialise(names.select("name").distinct(), "names")
    spans = distinct.where(F.length("name") <= LONGEST_LABEL).select(
        "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at")
    ).select(
        "name", "at",
        F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("at") + 1)))).alias("size"),
    ).select("name", "at", F.substring("name", F.col("at"), F.col("size")).alias("word")).where(F.length("word") >= 2)
    known = spans.join(counts.hint("merge"), "word").groupBy("name").agg(
        F.collect_list(F.struct("at", "word", "n")).alias("spans")  # at most 63 * 23 of them
    )

    def viterbi(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "name": b["name"],
                "words": [_viterbi(n, s if s is not None else [], total) for n, s in zip(b["name"], b["spans"])],
            })

    return distinct.join(known.hint("merge"), "name", "left").mapInPandas(viterbi, "name string, words array<string>")


def _viterbi(name: str, spans, total: float) -> list[str]:
    if len(name) > LONGEST_LABEL:
        return [name]
    by_start: dict[int, list] = {}
    for s in spans:
        by_start.setdefault(s["at"] - 1, []).append((s["word"], math.log(s["n"] / total)))
    best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(-math.inf, 0, "")] * len(name)
    for i in range(len(name)):
        moves = by_start.get(i, []) + [
            (name[i : i + k], math.log(1.0 / total) - 3.0 * k) for k in range(1, len(name) - i + 1)
        ]
        for word, cost in moves:
            j = i + len(word)
            if best[i][0] + cost > best[j][0]:
                best[j] = (best[i][0] + cost, i, word)
    out, j = [], len(name)
    while j:
        out.append(best[j][2])
        j = best[j][1]
    return out[::-1]


def judge(pages: DataFrame, rules=RULES, unwanted=UNWANTED, vocabulary: str | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, block_probability.

    Naive Bayes is trained on all pages: those with a seed word among their host's
    words are the blocked class.  A URL without words gets the class share.  Null
    and malformed URLs have empty host and path and no rule; repeated rows give
    repeated results; extra columns are ignored; empty tables give no rows."""
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("html").cast("string").alias("html"),
    )
    urls = materialise(
        rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
        .withColumn("url_id", F.xxhash64("host", "path")), "urls",
    )
    names = urls.select("host", "path", "pages").select(
        "host", "path", "pages", F.posexplode(F.array(_parts("host"), _parts("path"))).alias("place", "parts")
    ).select("host", "path", "pages", "place", F.explode("parts").alias("name")).where("name != ''")
    counts = materialise(unigrams(rows), "unigrams")  # read for its total and for the join
    split = materialise(segment(names, counts), "segments")
    words = names.join(split.hint("merge"), "name").select(
        "host", "path", "pages", "place", F.explode("words").alias("word")
    ).groupBy("host", "path", "pages", "place", "word").agg(F.count(F.lit(1)).alias("k"))
    words = materialise(words, "url_words")
    seeded = words.where((F.col("place") == 0) & F.col("word").isin(*unwanted)).select("host", "path").distinct()
    # the label of every distinct URL, weighted by its pages
    labelled = urls.join(seeded.withColumn("bad", F.lit(1)).hint("merge"), ["host", "path"], "left").select(
        "host", "path", "pages", F.coalesce("bad", F.lit(0)).alias("bad")
    )
    labelled = materialise(labelled, "url_labels")
    share = labelled.agg(F.sum("pages"), F.sum(F.col("pages") * F.col("bad"))).first()
    n_pages, n_bad = float(share[0] or 0), float(share[1] or 0)
    token_pages = words.join(labelled.select("host", "path", "bad").hint("merge"), ["host", "path"])
    per_word = token_pages.groupBy("place", "word").agg(
        F.sum(F.col("k") * F.col("pages") * F.col("bad")).alias("in_bad"),
        F.sum(F.col("k") * F.col("pages") * (1 - F.col("bad"))).alias("in_good"),
    )
    sums = per_word.agg(F.sum("in_bad"), F.sum("in_good"), F.count(F.lit(1))).first()
    all_bad, all_good, size = (float(x or 0) for x in sums)
    odds = per_word.select(
        "place", "word",
        (F.log((F.col("in_bad") + SMOOTHING) / (all_bad + SMOOTHING * size))
         - F.log((F.col("in_good") + SMOOTHING) / (all_good + SMOOTHING * size))).alias("odds"),
    )
    prior = math.log((n_bad + SMOOTHING) / (n_pages - n_bad + SMOOTHING))
    evidence = words.join(odds.hint("merge"), ["place", "word"]).groupBy("host", "path").agg(
        F.sum(F.col("k") * F.col("odds")).alias("evidence")
    )
    z = F.coalesce(F.col("evidence"), F.lit(0.0)) + prior
    verdicts = evidence.select("host", "path", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("probability"))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    by_rule = F.create_map(*(F.lit(x) for r in rules for x in r)) if rules else F.create_map()
    empty = 1.0 / (1.0 + math.exp(-prior))
    return rows.select("page_id", "host", "path").join(verdicts.hint("merge"), ["host", "path"], "left").withColumn(
        "rule", rule
    ).select(
        "page_id", "host", "path", "rule",
        F.coalesce(
            by_rule[F.col("rule")],
            F.when(F.coalesce("probability", F.lit(empty)) > 0.5, "block").otherwise("allow"),
        ).alias("verdict"),
        F.coalesce("probability", F.lit(empty)).alias("block_probability"),
    )
