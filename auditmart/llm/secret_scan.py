"""Operator 1, secret scans: candidates by shape, false positives removed by a
random forest.

A candidate is a run of key characters that is long and holds a digit, or very
long, or of a provider's format, or the value assigned to a credential word: all of
it, whatever its characters, up to its closing quote or the next white space.  Features: its length, character transitions (changes of
character class, likeliness of letter pairs), dictionary coverage (letters covered
by whole words of a public vocabulary), path (separators, URL and file context)
and neighbouring words (credential words, hashed words before and after).

The forest is trained on labelled findings.  :func:`rule_labels` supplies them
where no reviewed ones exist: provider formats and assignments to credential words
are secrets; numbers, addresses, paths, file names, identifiers and words are
false positives unless assigned to a credential word; the rest has no label and is
decided by the forest."""

from __future__ import annotations

import json
import math
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty
from .tokens import vocabulary_path

SAMPLE = 20_000  # labelled findings the forest is trained on, at most
TREES, DEPTH, SEED = 30, 8, 11
THRESHOLD = 0.5
HASHED_WORDS = 16

# --- fixed values: credential words and provider formats ------------------------------
CREDENTIAL = (
    "password passwd pwd passphrase secret token apikey api_key api-key access_key access-key secret_key secret-key "
    "auth_token auth-token client_secret private_key credential credentials bearer"
).split()
FORMATS = (
    r"(?:AKIA|ASIA|AGPA|AIDA|AROA)[0-9A-Z]{16}",  # cloud access key ids
    r"gh[pousr]_[A-Za-z0-9]{36,}",  # source hosting tokens
    r"glpat-[A-Za-z0-9_\-]{20,}",
    r"xox[abprs]-[A-Za-z0-9\-]{10,}",  # chat tokens
    r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}",  # payment keys
    r"AIza[A-Za-z0-9_\-]{35}",
    r"eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",  # signed web tokens
)

_FORMAT = re.compile("|".join(FORMATS))
_KEYWORD = re.compile(
    r"(?i)(?:" + "|".join(re.escape(w) for w in CREDENTIAL) + r")[\"']?\s*[:=]+>?\s*[\"']?$"
)
_SIGN = re.compile(r"[:=]+>?")
_VALUE = re.compile(
    r"[^\S\n]*(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|[\"']?(\S+?)(?=[,;.]?[\"'`]?[,;.]?(?:\s|$)|</|[,;][\"']))"
)
_RUN = re.compile(r"[A-Za-z0-9+/_.\-=~@:%]{8,}")
_WORD = re.compile(r"[^\W_]+")
_HARMLESS = re.compile(
    r"\d[\d.,:/\-]*|(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?|[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)+|(?:https?:/)?/[\w./\-%~]*|"
    r"[\w\-]+(?:\.[A-Za-z][\w\-]*)+(?:/.*)?|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Za-z.\-:]+"
)
_ASSIGNED = re.compile(r"[\"']?([A-Za-z][\w\-]*)[\"']?[:=][\"']?(.+)$")

FEATURES = 14 + HASHED_WORDS
_FOUND = "start long, end long, value string, label int, features array<float>"


@lru_cache(maxsize=1)
def _language(path: str) -> tuple[frozenset, dict]:
    """Whole words (3 letters or more) and log-likely letter pairs of the
    public vocabulary."""
    with open(path, encoding="utf-8") as f:
        known = json.load(f)["model"]["vocab"]
    words = frozenset(w[:-4] for w in known if w.endswith("</w>") and w[:-4].isalpha() and len(w) >= 7)
    pairs: dict[str, int] = {}
    for w in words:
        for a, b in zip(w, w[1:]):
            pairs[a + b] = pairs.get(a + b, 0) + 1
    total = sum(pairs.values())
    return words, {p: math.log(n / total) for p, n in pairs.items()}


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def coverage(value: str, words: frozenset) -> float:
    """Share of the characters covered by dictionary words, longest first."""
    low, i, covered = value.lower(), 0, 0
    while i < len(low):
        size = next((k for k in range(min(14, len(low) - i), 2, -1) if low[i : i + k] in words), 0)
        covered += size
        i += size or 1
    return covered / max(1, len(low))


def features(value: str, before: str, after: str, language: tuple[frozenset, dict]) -> list[float]:
    words, pairs = language
    n = len(value)
    kinds = [_kind(c) for c in value]
    letters = [a + b for a, b in zip(value.lower(), value.lower()[1:]) if (a + b).isalpha()]
    counts = [value.count(c) / n for c in set(value)]
    near = _WORD.findall(before.lower())[-2:] + _WORD.findall(after.lower())[:1]
    hashed = [0.0] * HASHED_WORDS
    for w in near:
        hashed[zlib.crc32(w.encode()) % HASHED_WORDS] = 1.0
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        sum(pairs.get(p, -14.0) for p in letters) / max(1, len(letters)),
        len(letters) / max(1, n - 1),
        *(kinds.count(k) / n for k in range(4)),
        -sum(p * math.log2(p) for p in counts),
        coverage(value, words),
        float(value.count("/") + value.count(".")),
        float(before.endswith(("/", "://", "@", ".", "\\")) or after.startswith(("/", "@", "."))),
        float(_KEYWORD.search(before) is not None),
        float(before.rstrip("\"' ").endswith(("=", ":"))),
        *hashed,
    ]


def rule_label(value: str, before: str) -> int | None:
    """1 secret, 0 false positive, None undecided."""
    if _FORMAT.fullmatch(value):
        return 1
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    if _KEYWORD.search(before):
        return 1 if len(value) >= 8 and mixed else None
    return 0 if _HARMLESS.fullmatch(value) else None


def assigned_values(text: str):
    """(start, end) of the values assigned to credential words."""
    done = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < done:
            continue
        name = text[max(0, sign.start() - 40) : sign.start()].rstrip()
        if not (name[:-1] if name.endswith(("'", '"')) else name).lower().endswith(tuple(CREDENTIAL)):
            continue
        m = _VALUE.match(text, sign.end())
        # a sentence in quotes that holds a provider's key is no value
        if m and not (" " in m[m.lastindex] and _FORMAT.search(m[m.lastindex])):
            done = m.end(m.lastindex)
            yield m.span(m.lastindex)


def candidates(text: str):
    """(start, end) of the candidates of a text, none inside another."""
    at = 0
    for start, end in assigned_values(text):
        yield from _shaped(text, at, start)
        yield start, end
        at = end
    yield from _shaped(text, at, len(text))


def _shaped(text: str, begin: int, stop: int):
    """(start, end) of the candidates by shape in text[begin:stop]."""
    for m in _RUN.finditer(text, begin, stop):
        start, end = m.span()
        value = m.group().rstrip(".:=%-,")
        assigned = _ASSIGNED.match(value)
        if assigned and assigned[1].lower() in CREDENTIAL:
            start, value = start + assigned.start(2), assigned[2]
        end = start + len(value)
        digit = any(c.isdigit() for c in value)
        if (len(value) >= 12 and digit) or len(value) >= 24 or _FORMAT.fullmatch(value) or (
            digit and len(value) >= 8 and _KEYWORD.search(text, max(0, start - 40), start)
        ):
            yield start, end


def findings(docs: DataFrame, keep: list[str], vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and one row per candidate in ``text``: start,
    end (characters), value, label (rule label, null if undecided), features."""
    prepare(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    names = [*keep, "start", "end", "value", "label", "features"]
    rows = docs.select(*keep, text_or_empty("text").alias("_text"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float32())]

    def run(batches: Batches) -> Batches:
        language = _language(path)
        for b in batches:
            out = []
            for i, text in enumerate(b.column(len(keep)).to_pylist()):
                for start, end in candidates(text):
                    value, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 24]
                    out.append((i, start, end, value, rule_label(value, before), features(value, before, after, language)))
            columns = list(zip(*out)) or [()] * 6
            at = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in b.columns[: len(keep)]), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))],
                names,
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), _FOUND])
    return rows.mapInArrow(run, schema)


def train(labelled: DataFrame, sample: int = SAMPLE):
    """A random forest over ``features`` for ``label``, from at most ``sample``
    labelled findings per label chosen by hash of their value; equal values count once.
    None if one of the labels is missing."""
    rows = labelled.where(F.col("label").isin(0, 1)).groupBy("value").agg(
        F.max("label").alias("label"), F.max_by("features", F.struct("label", "features")).alias("features")
    )
    by_hash = [F.xxhash64("value"), F.col("value")]
    each = [rows.where(F.col("label") == k).orderBy(*by_hash).limit(sample // 2) for k in (0, 1)]
    rows = materialise(each[0].union(each[1]), "secret_training")
    if rows.select("label").distinct().count() < 2:
        return None
    rows = rows.select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2).fit(rows)


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score`` and ``is_secret``; without a model the rule
    label decides."""
    if model is None:
        scored = found.withColumn("score", F.coalesce(F.col("label"), F.lit(0)).cast("double"))
    else:
        scored = model.transform(found.withColumn("_vector", array_to_vector("features")).drop("features").withColumnRenamed("_vector", "features"))
        scored = scored.withColumn("score", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )
    return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)


def held_out(value: str = "value") -> Column:
    """Findings kept from training to measure accuracy."""
    return F.pmod(F.xxhash64(F.col(value), F.lit(1)), F.lit(4)) == 2


def scan(docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per candidate of every whole text: doc_id, start, end, value,
    label, held_out, score, is_secret.

    ``labelled``: reviewed findings (value, label, features); default: the rule
    labels of the candidates themselves, a quarter held out.  Null and empty texts
    have no candidates; a null doc_id stays null; repeated rows give repeated
    findings; extra columns are ignored; an empty table gives no rows."""
    found = findings(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"])
    found = materialise(found, "findings")
    model = train(found.where(~held_out()) if labelled is None else labelled, sample)
    return judge(found.withColumn("held_out", held_out()), model).select(
        "doc_id", "start", "end", "value", "label", "held_out", "score", "is_secret"
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every confirmed secret replaced by ``mark`` and ``n_chars``
    (where present) recounted; all rows and columns stay, whatever the columns' names.
    Null and empty texts stay as they are, repeated rows are redacted alike, a text of any
    length is read whole and an empty table gives an empty one."""
    rows = materialise(
        docs.select(F.monotonically_increasing_id().alias("_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")),
        "redact",
    )
    found = materialise(findings(rows.select("_id", F.col("_row.text").alias("text")), ["_id"]), "findings")
    model = train(found.where(~held_out()) if labelled is None else labelled, sample)
    spans = judge(found, model).where("is_secret").groupBy("_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans")  # one document's own findings
    )
    joined = rows.join(spans.hint("merge"), "_id", "left")
    # pieces between the secrets, then the rest; offsets count code points
    text = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.concat(s["done"], F.substring(F.col("_row.text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark)).alias("done"),
            x["end"].alias("at"),
        ),
        lambda s: F.concat(s["done"], F.substring(F.col("_row.text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    joined = joined.withColumn("_text", F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(text))
    out = []
    for f in docs.schema:
        c = F.col(f"_row.`{f.name}`")
        if f.name == "text":
            c = F.col("_text")
        elif f.name == "n_chars":
            c = F.when(F.col("_spans").isNull(), c).otherwise(F.char_length("_text").cast(f.dataType))
        out.append(c.alias(f.name))
    return joined.select(*out)
