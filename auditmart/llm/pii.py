"""Operator 11, personal data: rules find seeds, and what surrounds and shapes the
seeds finds what the rules miss.

Base spans (e-mail addresses, IP addresses, card and phone numbers) come from fixed
rules.  All other identifier-like stretches of a text are candidates.  Both are
instances of lexical patterns: the shape of the instance, the words beside it, text
stuck to its front and, for addresses, the host.  Instances (values) and patterns form a
graph.  A pattern trusts the share of its instances that are known, an instance believes
its best pattern of each type; accepted instances count as known in the next round.  So
a phone number that runs into a card number, which the rules drop, is found by its
shape, and a shape no rule knows by the word before it.

Values are counted once however often they are copied.  How selective a
neighbouring word is is judged against all its occurrences in all texts."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty

# --- fixed values: kinds in the order they are listed, and the base rules ----------------
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGIT_RUNS = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
INTERNATIONAL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = range(14, 20)
PHONE_DIGITS = range(10, 16)
SPACE = r"[\x20\x09-\x0D]+"

# --- parameters ------------------------------------------------------------------
ACCEPT = 0.9  # belief from which an instance is known
MIN_SUPPORT = 3  # known values a pattern needs before it counts
ROUNDS = 3  # times that patterns and instances score each other
REACH = 64  # characters looked at beside an instance
MAX_PIECES = 4  # space-separated pieces of a candidate
HOT_SHARE = 0.001  # a pattern with a larger share of all edges is joined apart

_ANY = re.compile("[0-9@]")
_PIECE = re.compile(r"[+(]{0,2}[0-9](?:[0-9().+-]*[0-9)])?")
_SPLIT = re.compile(SPACE)
_EDGE = re.compile(r"[\w@]")
_ADDRESS_STOP = re.compile(r"""[\s@<>()\[\]{},;:"'|]""")


# --- base spans -----------------------------------------------------------------------


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return (sum(map(int, digits[-1::-2])) + sum(double[int(c)] for c in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: a local part is the run of its characters before it, so
    the text is walked once, whatever the length of its words."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = HOST.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def _addresses(text: str, runs: range | None = None) -> Iterator[tuple[int, int, bool]]:
    """(start, end, valid) of four dotted numbers: by the rule every four in a
    row, from the left of a dotted run."""
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            yield at, end, all(map(_small, four))
            at = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed rules, by start and then kind."""
    if not _ANY.search(text):
        return []
    out = [(s, EMAIL, e) for s, e in _emails(text)]
    out += [(s, IP, e) for s, e, valid in _addresses(text) if valid]
    for m in DIGIT_RUNS.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _digits(m[0])
            if len(digits) in CARD_DIGITS and luhn(digits):
                out.append((m.start(), CARD, m.end()))
    for m in INTERNATIONAL.finditer(text):
        if len(_digits(m[0])) in PHONE_DIGITS:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


# --- candidates and their patterns ----------------------------------------------------


class Taken:
    """Spans that do not overlap, in order."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i == 0 or self.ends[i - 1] <= start

    def add(self, start: int, end: int) -> None:
        """Kept as disjoint stretches: what overlaps or touches is merged."""
        i = bisect_left(self.ends, start)
        j = bisect_left(self.starts, end + 1)
        if i < j:
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [start], [end]


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of stretches that could be an identifier and touch no base
    span: 1 to ``MAX_PIECES`` numbers with single spaces between (card: 12 to 19
    digits, phone: 7 to 15), four valid parts anywhere in a dotted run, and
    anything@anything."""
    if not _ANY.search(text):
        return
    taken = Taken()
    for s, _, e in base:
        taken.add(s, e)
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and at - start < REACH and not _ADDRESS_STOP.match(text[start - 1]):
            start -= 1
        while end < len(text) and end - at <= 4 * REACH and not _ADDRESS_STOP.match(text[end]):
            end += 1
        while end > at + 1 and text[end - 1] in ".!?":
            end -= 1
        if start < at and end > at + 1 and taken.free(start, end):
            yield start, EMAIL, end
        at = text.find("@", at + 1)
    pieces: list[tuple[int, int, int]] = []  # the last few numbers: start, end, digits
    for m in _PIECE.finditer(text):
        start, end = m.span()
        if (start and _EDGE.match(text[start - 1])) or (end < len(text) and _EDGE.match(text[end])):
            pieces = []
            continue
        if pieces and not (start == pieces[-1][1] + 1 and text[start - 1] == " "):
            pieces = []
        pieces = [*pieces[1 - MAX_PIECES :], (start, end, len(_digits(m[0])) if end - start <= REACH else REACH)]
        digits = 0
        for first, _, n in reversed(pieces):
            digits += n
            if digits > 19:
                break
            if not taken.free(first, end):
                break
            if 12 <= digits and all(c in "0123456789 -" for c in text[first:end]):
                yield first, CARD, end
            if 7 <= digits <= 15 and "." not in text[first:end].strip("."):
                yield first, PHONE, end
        if m[0].count(".") >= 4:
            for run in DOTTED.finditer(m[0]):
                parts = run[0].split(".")
                at = start + run.start()
                for i in range(len(parts) - 3):
                    stop = at + sum(map(len, parts[i : i + 4])) + 3
                    if all(map(_small, parts[i : i + 4])) and taken.free(at, stop):
                        yield at, IP, stop
                    at += len(parts[i]) + 1


_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


def _shape(text: str, kind: int) -> str:
    if kind == EMAIL:  # runs of any length
        return _RUNS.sub(lambda m: "9" if "0" <= m[0][0] <= "9" else "a", text)
    shape = re.sub("[0-9]", "9", text) if kind != IP else "9.9.9.9"
    return shape + (" luhn" if kind == CARD and luhn(_digits(text)) else "")


def value_of(text: str, kind: int) -> str:
    """What makes two occurrences the same instance."""
    return text.lower() if kind in (EMAIL, IP) else _digits(text)


def patterns(text: str, start: int, kind: int, end: int) -> list[tuple[str, str]]:
    """(type, key) of the patterns that a span is an instance of: S its shape, H its
    host, G the text stuck to its front, L and R the whole words beside it."""
    span = text[start:end]
    out = [("S", _shape(span, kind))]
    if kind == EMAIL:
        out.append(("H", span[span.rindex("@") + 1 :].lower()))
    left, right = _SPLIT.split(text[max(0, start - REACH) : start]), _SPLIT.split(text[end : end + REACH])
    if left[-1]:
        out.append(("G", left[-1][-16:]))
    elif len(left) > 1 and left[-2]:
        out.append(("L", left[-2]))
    if len(right) > 1 and not right[0] and right[1]:
        out.append(("R", right[1]))
    return out


# --- one pass over the texts -------------------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_INSTANCE = pa.struct([
    ("kind", pa.int32()), ("value", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()),
    ("patterns", pa.list_(pa.struct([("type", pa.string()), ("key", pa.string())]))),
])
_READ = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("base", pa.list_(_SPAN)), ("instances", pa.list_(_INSTANCE))])
READ_SCHEMA = (
    "row long, doc_id long, base array<struct<start:bigint,kind:int,end:bigint>>, instances array<struct<kind:int,"
    "value:string,start:bigint,end:bigint,seed:boolean,patterns:array<struct<type:string,key:string>>>>"
)


def read(docs: DataFrame) -> DataFrame:
    """Base spans and instances (seeds and candidates) of every row of ``docs`` (doc_id,
    text); written, with a number per row since ids may be null or repeated."""
    prepare(docs.sparkSession)

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base = base_spans(text)
                spans = [(s, True) for s in base] + [(s, False) for s in candidates(text, base)]
                rows.append({
                    "row": number, "doc_id": doc_id,
                    "base": [{"start": s, "kind": k, "end": e} for s, k, e in base],
                    "instances": [
                        {"kind": k, "value": value_of(text[s:e], k), "start": s, "end": e, "seed": seed,
                         "patterns": [{"type": t, "key": p} for t, p in patterns(text, s, k, e)]}
                        for (s, k, e), seed in spans
                    ],
                })
                number += 1
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialise(rows.mapInArrow(run, READ_SCHEMA), "pii_read")


# --- the pattern-instance graph ------------------------------------------------------------

PATTERN = ["kind", "type", "key"]
VALUE = ["kind", "value"]


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, n_words): how often each white-space separated word occurs in all texts."""
    words = docs.select(F.explode(F.split(text_or_empty(), SPACE)).alias("key")).where("key != ''")
    return words.groupBy("key").agg(F.count(F.lit(1)).alias("n_words"))


def edges(instances: DataFrame) -> DataFrame:
    """(kind, type, key, value, n, seed): a value under a pattern, how often, and
    whether it is a seed anywhere; written."""
    pairs = instances.select(*VALUE, F.inline("patterns")).groupBy(*PATTERN, "value").agg(F.count(F.lit(1)).alias("n"))
    seeds = instances.where("seed").select(*VALUE).distinct().withColumn("seed", F.lit(True))
    return materialise(
        pairs.join(seeds, VALUE, "left").select(*PATTERN, "value", "n", F.coalesce("seed", F.lit(False)).alias("seed")),
        "pii_edges",
    )


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], heavy: Column) -> DataFrame:
    """``left`` joined to ``right`` (unique on ``keys``); the rows of ``right`` that are
    ``heavy`` are broadcast, so their keys need not meet in one task.  The caller
    proves that few can be heavy."""
    hot, cold = right.where(heavy), right.where(~heavy)
    apart = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(apart.hint("merge").join(cold, keys))


def _trust(known: Column, members: Column, known_n: Column, n_words: Column) -> Column:
    beside = F.col("type").isin("L", "R")
    share = F.when(beside, known_n / (n_words + 1)).otherwise(known / (members + 1))
    return F.when(known >= MIN_SUPPORT, F.least(share, F.lit(1.0))).otherwise(F.lit(0.0))


def bootstrap(edges: DataFrame, words: DataFrame) -> DataFrame:
    """(kind, value, belief) of the accepted values that are no seeds, after ``ROUNDS``
    rounds.

    Trust of a pattern: known values / (all its values + 1); for a word beside, known
    occurrences / (all occurrences of the word + 1); none below ``MIN_SUPPORT`` known
    values.  Belief of a value: 1 - product over the types of (1 - its most trusted
    pattern).  Only values without a rule's support are scored; an edge of theirs meets
    its pattern by :func:`spread_join`.  A pattern that holds more than ``HOT_SHARE``
    of all edges is heavy, so at most 1 / ``HOT_SHARE`` of them are broadcast."""
    total = edges.count()
    known = F.col("seed")
    stats = edges.groupBy(*PATTERN).agg(
        F.count(F.lit(1)).alias("members"),
        F.count(F.when(known, 1)).alias("seeds"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("seed_n"),
    )
    # a word no seed stands beside may still gain support, so all are looked up
    beside = stats.where("type IN ('L', 'R')")
    looked_up = beside.hint("merge").join(words, "key", "left").select(*stats.columns, F.coalesce("n_words", F.col("members")).alias("n_words"))
    other = stats.where("type NOT IN ('L', 'R')").withColumn("n_words", F.lit(0).cast("long"))
    stats = materialise(looked_up.unionByName(other), "pii_patterns")
    open_edges = materialise(edges.where(~known).drop("seed"), "pii_open")
    accepted = None
    for _ in range(ROUNDS):
        if accepted is None:
            scored = stats.withColumn("gained", F.lit(0).cast("long")).withColumn("gained_n", F.lit(0).cast("long"))
        else:
            gained = open_edges.join(accepted.select(*VALUE), VALUE, "left_semi").groupBy(*PATTERN).agg(
                F.count(F.lit(1)).alias("gained"), F.sum("n").alias("gained_n")
            )
            scored = stats.join(gained, PATTERN, "left").fillna(0, ["gained", "gained_n"])
        trust = _trust(F.col("seeds") + F.col("gained"), F.col("members"), F.col("seed_n") + F.col("gained_n"), F.col("n_words"))
        trusted = scored.select(*PATTERN, "members", trust.alias("trust")).where("trust > 0")
        heavy = F.col("members") > F.lit(HOT_SHARE * total)
        met = spread_join(open_edges, trusted, PATTERN, heavy)
        best = [F.coalesce(F.max(F.when(F.col("type") == t, F.col("trust"))), F.lit(0.0)) for t in "SHGLR"]
        doubt = F.lit(1.0)
        for b in best:
            doubt = doubt * (F.lit(1.0) - b)
        accepted = materialise(
            met.groupBy(*VALUE).agg((F.lit(1.0) - doubt).alias("belief")).where(F.col("belief") >= ACCEPT), "pii_accepted"
        )
    return accepted


# --- spans of the documents -----------------------------------------------------------------


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def settle(base: list[tuple[int, int, int]], found: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans and, most believed first (then longest, then leftmost), the found
    (belief, start, kind, end) that overlap none taken before."""
    taken = Taken()
    for s, _, e in base:
        taken.add(s, e)
    out = list(base)
    for _, s, k, e in sorted(found, key=lambda f: (-f[0], f[1] - f[3], f[1], f[2])):
        if taken.free(s, e):
            taken.add(s, e)
            out.append((s, k, e))
    return sorted(out)


RESULT_SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_found long, "
    "found array<struct<kind:string,start:bigint,end:bigint,belief:double>>"
)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id; n_email, n_ip, n_card, n_phone, the base spans
    by kind; base_sha256, of ``kind:start:end`` of the base spans; spans, the same
    list of base and found spans; n_found and found, what the patterns added with its
    belief.  Offsets are code points, ends exclusive.

    Null and empty texts have no spans (the hash is that of '').  Repeated rows and
    null ids each get their row; a copied value is one instance.  Extra columns
    are ignored; an empty table gives no rows.  Texts are read whole and in time linear
    in their length, words of any length included."""
    made = read(docs)
    instances = made.select("row", F.inline("instances"))
    accepted = bootstrap(edges(instances), word_counts(docs))
    # a seed's value needs no patterns where another rule's text swallowed it
    known = instances.where("seed").select(*VALUE).distinct().withColumn("belief", F.lit(1.0)).unionByName(accepted)
    counted = instances.where("NOT seed").groupBy(*VALUE).agg(F.count(F.lit(1)).alias("n"))
    known = materialise(known.join(counted, VALUE), "pii_known")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    occurrences = instances.where("NOT seed").select("row", *VALUE, "start", "end")
    met = spread_join(occurrences, known, VALUE, F.col("n") > F.lit(HOT_SHARE * total))
    found = met.groupBy("row").agg(F.collect_list(F.struct("belief", "start", "kind", "end")).alias("found"))
    rows = made.select("row", "doc_id", "base").hint("merge").join(found, "row", "left").select("doc_id", "base", "found")

    def run(batches: Batches) -> Batches:
        for b in batches:
            out = []
            for doc_id, base, found in zip(*(c.to_pylist() for c in b.columns)):
                base = [(s["start"], s["kind"], s["end"]) for s in base]
                found = [(f["belief"], f["start"], f["kind"], f["end"]) for f in found or []]
                spans = settle(base, found)
                belief = {f[1:]: f[0] for f in found}
                added = sorted(set(spans) - set(base))
                out.append({
                    "doc_id": doc_id, **{f"n_{n}": sum(k == i for _, k, _ in base) for i, n in enumerate(KINDS)},
                    "base_sha256": hashlib.sha256(_joined(base).encode()).hexdigest(), "spans": _joined(spans),
                    "n_found": len(added),
                    "found": [{"kind": KINDS[k], "start": s, "end": e, "belief": belief[s, k, e]} for s, k, e in added],
                })
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT)

    return rows.mapInArrow(run, RESULT_SCHEMA)


_RESULT = pa.schema([
    ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
    ("n_found", pa.int64()),
    ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("belief", pa.float64())]))),
])
