"""Operator 3, toxicity: a weighted finite-state grammar over clauses.

Small transducers read the words of a clause as symbols (insult, threat,
target, negation, reported speech, other).  Each multiplies or adds a weight
when it reads a symbol; their composition (the product machine) scores the whole
clause, so "you are an X", "he said X" and "not X" weigh differently and a word
outside any pattern weighs nothing.  Insult words, insult stems (the first four to
seven letters of a word, written ``stem*``) and their weights are learned from
labelled documents; a logistic curve over a document's clause scores gives its
score."""

from __future__ import annotations

import itertools
import math
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty

SAMPLE = 20_000  # labelled documents the model is fitted on, at most
MIN_CONTEXTS = 6  # different preceding words an insult word needs in toxic texts
MIN_WEIGHT = 2.5  # its log odds
STEMS = (4, 5, 6, 7)  # letters of a stem
MAX_WORDS = 5_000  # learned words kept, heaviest first
THRESHOLD = 0.3
FEATURES = ("_sum", "_max", "_n", "_length")

# --- fixed values: closed word classes of the grammar -------------------------------
THREAT = "kill hurt destroy beat shoot töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()
TARGET = (
    "you your yours he she they them his her their those these du dich dein ihr euch sie er tu toi vous votre il elle "
    "ils elles tú usted ustedes él ella ellos ellas"
).split()
NEGATION = "not no never none isn't aren't wasn't don't nicht kein keine nie pas jamais ni aucun nunca ningún tampoco".split()
REPORTED = (
    "said says saying called calls quoted claimed wrote reported sagte sagt nannte dit disait appelé cité dijo dice "
    "llamó citó"
).split()

OTHER, INSULT, THREATENS, TARGETS, NEGATES, REPORTS = range(6)


class Transducer:
    """States 0 .. n-1; ``step(state, symbol) -> (state, factor, added)``."""

    def __init__(self, states: int, step):
        self.states, self.step = states, step


def _scope(trigger: int, width: int, reader: int, factor: float = 1.0, added: float = 0.0) -> Transducer:
    """After ``trigger``, for ``width`` symbols, reading ``reader`` multiplies
    by ``factor`` and adds ``added``."""

    def step(state, symbol):
        hit = symbol == reader and state > 0
        return (
            width if symbol == trigger else max(0, state - 1),
            factor if hit else 1.0,
            added if hit else 0.0,
        )

    return Transducer(width + 1, step)


def compose(*parts: Transducer) -> list[list[tuple[int, float, float]]]:
    """The product machine as a table [state][symbol] -> (state, factor, added)."""
    states = list(itertools.product(*(range(p.states) for p in parts)))
    number = {s: i for i, s in enumerate(states)}
    table = []
    for s in states:
        row = []
        for symbol in range(6):
            moves = [p.step(x, symbol) for p, x in zip(parts, s)]
            row.append((number[tuple(m[0] for m in moves)], math.prod(m[1] for m in moves), sum(m[2] for m in moves)))
        table.append(row)
    return table


GRAMMAR = compose(
    _scope(NEGATES, 3, INSULT, factor=0.5),
    _scope(REPORTS, 4, INSULT, factor=0.5),
    _scope(TARGETS, 4, INSULT, factor=1.5),
    _scope(THREATENS, 4, TARGETS, added=3.0),
)

_CLAUSE_END = re.compile(r"[.,;:!?\n]")
_WORD = re.compile(r"\w+(?:'\w+)?")


class Scorer:
    """Clause scores of lower-cased texts for a learned insult lexicon."""

    def __init__(self, insults: dict[str, float]):
        self.insults = insults
        self.symbols = {w: REPORTS for w in REPORTED} | {w: NEGATES for w in NEGATION} | {w: TARGETS for w in TARGET}
        self.symbols |= {w: THREATENS for w in THREAT}
        self.trie = ahocorasick.Automaton()
        for w in [*insults, *THREAT]:
            self.trie.add_word(w.rstrip("*"), (len(w.rstrip("*")), w.endswith("*")))
        self.trie.make_automaton()
        self.read = lru_cache(maxsize=100_000)(self._read)

    def _read(self, word: str) -> tuple[int, float]:
        """The symbol of a word and its insult weight."""
        weight = max(self.insults.get(x, 0.0) for x in _forms(word))
        return (INSULT if weight else self.symbols.get(word, OTHER)), weight

    def clause(self, words: list[str]) -> float:
        state, total = 0, 0.0
        for w in words:
            symbol, weight = self.read(w)
            state, factor, added = GRAMMAR[state][symbol]
            total += weight * factor + added
        return total

    def features(self, text: str) -> tuple[float, float, float, float]:
        """log(1 + sum), maximum and log(1 + number) of the matched clauses, and
        log(1 + length) of the text if any matched (chance matches grow with it)."""
        text, done, scores = text.lower(), -1, []
        for last, (size, stem) in self.trie.iter(text):
            start = last - size + 1
            if start <= done or (start and _wordy(text[start - 1])):
                continue
            if not stem and last + 1 < len(text) and _wordy(text[last + 1]):
                continue
            # the last clause ended at a separator, so no search goes back beyond it
            begin = max(text.rfind(c, max(done, 0), start) for c in ".,;:!?\n") + 1
            end = _CLAUSE_END.search(text, last)
            done = end.start() if end else len(text)
            score = self.clause(_WORD.findall(text, begin, done))
            if score > 0:
                scores.append(score)
        length = math.log1p(len(text)) if scores else 0.0
        return math.log1p(sum(scores)), max(scores, default=0.0), math.log1p(len(scores)), length


def _forms(word: str) -> tuple[str, ...]:
    return (word, *(word[:n] + "*" for n in STEMS if len(word) > n))


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


@lru_cache(maxsize=2)
def _scorer(insults: tuple[tuple[str, float], ...]) -> Scorer:
    return Scorer(dict(insults))


def _clause_features(rows: DataFrame, insults: dict[str, float], keep: list[str]) -> DataFrame:
    """``keep`` columns and the clause features of ``_text``, one scan."""
    lexicon = tuple(sorted(insults.items()))
    names = [*keep, *FEATURES]
    schema = rows.select(*keep, *(F.lit(0.0).alias(n) for n in FEATURES)).schema

    def run(batches: Batches) -> Batches:
        scorer = _scorer(lexicon)
        for b in batches:
            found = [scorer.features(t) for t in b.column(len(keep)).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in (zip(*found) if found else [()] * len(FEATURES))]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *columns], names)

    return rows.select(*keep, text_or_empty("_text").alias("_text")).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 4 = 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents outside the held
    out quarter, chosen by hash of their ids; equal texts count once."""
    chosen = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # at most ``sample`` pairs of numbers: the size bound of the broadcast
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy(F.sha2(F.col("text"), 256)).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")
    ).select("text", "toxic")


def learn_insults(
    rows: DataFrame, min_contexts: int = MIN_CONTEXTS, min_weight: float = MIN_WEIGHT, max_words: int = MAX_WORDS
) -> dict[str, float]:
    """Words and stems whose log odds in toxic texts are high.  What counts is the number
    of different preceding words, not of texts, so the words of one much-copied
    toxic text are not taken for insults."""
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")
    pairs = rows.select("toxic", words.alias("w")).select(
        "toxic", F.explode(F.arrays_zip(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))).alias("a"),
                                        F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("b"))).alias("p")
    ).select("toxic", F.col("p.a").alias("a"), F.col("p.b").alias("b")).where("b != ''").distinct()
    pairs = materialise(pairs, "word_pairs")  # read for the words and for the totals
    forms = F.array(F.col("b"), *(
        F.when(F.length("b") > n, F.concat(F.substring("b", 1, n), F.lit("*"))) for n in STEMS
    ))
    per_word = pairs.select("toxic", "a", F.explode(F.array_compact(forms)).alias("b")).groupBy("b").agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("t"), F.sum((F.col("toxic") == 0).cast("long")).alias("c")
    )
    sums = pairs.agg(F.sum((F.col("toxic") == 1).cast("long")), F.sum((F.col("toxic") == 0).cast("long"))).first()
    all_t, all_c = (sums[0] or 0), (sums[1] or 0)
    weight = F.log((F.col("t") + 0.5) / (all_t + 1)) - F.log((F.col("c") + 0.5) / (all_c + 1))
    top = (
        per_word.where(F.col("t") >= min_contexts).select("b", weight.alias("w")).where(F.col("w") >= min_weight)
        .orderBy(F.desc("w"), "b").limit(max_words).collect()
    )
    return {r["b"]: round(float(r["w"]), 6) for r in top}


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a ridge logistic regression; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


class Model:
    def __init__(self, insults: dict[str, float], curve: list[float]):
        self.insults, self.curve = insults, curve

    def score(self, rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """``keep`` columns of ``rows`` and ``score`` (0 to 1) of ``text``."""
        found = _clause_features(rows.select(*keep, F.col(text).alias("_text")), self.insults, keep)
        z = F.lit(float(self.curve[-1]))
        for name, weight in zip(FEATURES, self.curve):
            z = z + F.col(name) * F.lit(float(weight))
        return found.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn the lexicon and the curve from labelled rows that are not held
    out.  Only numbers and words reach the driver: at most ``MAX_WORDS`` words
    and ``sample`` rows of four features.  Without labelled rows of both
    classes every text scores the class share (0 without any row)."""
    prepare(docs.sparkSession)
    rows = labelled(docs, labels, sample)
    insults = learn_insults(rows)
    seen = np.array(
        [[*(r[f] for f in FEATURES), r["toxic"]]
         for r in _clause_features(rows.withColumnRenamed("text", "_text"), insults, ["toxic"]).collect()]
    ).reshape(-1, len(FEATURES) + 1)
    y = seen[:, -1]
    if len(set(y.tolist())) < 2:
        return Model(insults, [0.0] * len(FEATURES) + [30.0 if len(y) and y[0] else -30.0])
    return Model(insults, fit_logistic(seen[:, :-1], y).tolist())


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.3).

    Null texts score like empty ones; a null doc_id stays null and is not held
    out; repeated rows give repeated results; extra columns are ignored; an empty
    table gives no rows.  A text of any length is read whole, in time linear in it."""
    model = fit(docs, labels, sample)
    scored = model.score(docs.select(F.col("doc_id").cast("long"), "text"), "text", ["doc_id"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all columns, whatever
    their names.  Null and empty texts score like a text without a match; repeated rows are
    kept or dropped together; an empty table gives no rows."""
    model = fit(docs, labels, sample)
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text").alias("_text"))
    scored = model.score(kept, "_text", ["_row"])
    return scored.where(F.col("score") < THRESHOLD).select("_row.*")
