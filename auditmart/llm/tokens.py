"""Operator 5, token counts: an exact length histogram.

Documents are encoded whole, aggregated by encoded length, and suffix sums over
the histogram answer totals, quantiles and truncated totals for every context
limit.  Only (length, count) pairs are shuffled after the encoding pass."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty, texts_of

CACHE_ENTRIES = 1_000_000  # words a worker remembers; it starts anew beyond that
VOCABULARY = "word_bpe_49k.json"
BLOCK = 1024  # histogram lengths per suffix-sum block


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file, as little-endian uint16
    (or uint32 beyond 65,536 ids) bytes.

    The word-level vocabulary drops white space and never merges across it.
    Texts of ASCII and accented Latin letters take ``WordRanks`` where the
    vocabulary allows it, all their words at once.  Other texts are the
    concatenation of their white-space separated pieces, which are remembered; texts
    with separators the two libraries see differently are encoded whole.  Other
    vocabularies (``by_word=False``) always encode whole texts."""

    _PLAIN = re.compile("([a-zßà-öø-ÿ]+)([.,!?;:%$&#*]*)")
    _ODD = re.compile(r"[\x1c-\x1f]")

    def __init__(self, path: str, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.by_word = by_word
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.word_end = np.zeros(size, bool)
        self.word_end[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.ranks = WordRanks.of(path, self.dtype) if by_word else None

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _learn(self, pieces: set[str]) -> None:
        """Encode unknown pieces: plain words (one pre-token each, ending in
        one end-of-word id) joined in one call, all others one by one."""
        known, width = self.known, self.dtype.itemsize
        parts = {p: self._PLAIN.fullmatch(p.lower()) for p in pieces}
        single = {p for p, m in parts.items() if m is None} | {m[2] for m in parts.values() if m and m[2]}
        single = [p for p in single if p not in known]
        known.update(zip(single, self._whole(single)))
        words = list({m[1] for m in parts.values() if m and m[1] not in known})
        if words:
            ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, self.dtype)
            cuts = np.flatnonzero(self.word_end[ids]) + 1
            if len(cuts) == len(words):
                data, at = ids.tobytes(), [0, *cuts.tolist()]
                known.update((w, data[width * i : width * j]) for w, i, j in zip(words, at, at[1:]))
            else:
                known.update(zip(words, self._whole(words)))
        for p, m in parts.items():
            if m:
                known[p] = known[m[1]] + known[m[2]] if m[2] else known[m[1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        if self.ranks is None:
            return self._by_piece(texts)
        out = self.ranks.encode(texts)
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._by_piece([texts[i] for i in rest]) if rest else ()):
            out[i] = ids
        return out

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if self._ODD.search(t)]
        split = [t.split() for t in texts]
        for i in odd:
            split[i] = []
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        missing = set().union(*split).difference(self.known)
        if missing:
            self._learn(missing)
        get = self.known.__getitem__
        out = [b"".join(map(get, words)) for words in split]
        if odd:
            for i, ids in zip(odd, self._whole([texts[i] for i in odd])):
                out[i] = ids
        return out


class WordRanks:
    """A word-level BPE vocabulary as ranks of byte strings, for texts of ASCII
    and accented Latin letters.

    The last byte of a word is a symbol of its own (``</w>`` in the vocabulary).
    Every byte becomes one character, another one where it ends a word, so words
    need no separator and a text is encoded in one call.

    Merging by ranks takes the adjacent pair whose joint string ranks first, merging
    by a list the pair that is listed first.  Both agree if every string is the
    result of one listed merge and merges to itself when it stands alone: what
    has been merged inside a string's span, before anything crosses its ends, is what
    is merged when it stands alone, so the two parts it is joined from are always the
    listed ones.  Strings that do not merge to themselves never arise from the list
    and are left out of the ranks."""

    NORMALIZERS = ["NFC", "Replace", "Lowercase"]
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LONGEST = 400  # bytes of a word; texts with longer ones are left to the caller
    _PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
    _SPACE, _LETTER, _DIGIT, _OTHER = range(4)

    def __init__(self, ranks: dict[bytes, int], ids: np.ndarray, special: list[str]):
        import tiktoken

        word = "[a-z\u0100-\u01ff]*[A-Z\u0200-\u02ff]"
        self.merger = tiktoken.Encoding("words", pat_str=word, mergeable_ranks=ranks, special_tokens={})
        self.ids = ids
        self.special = special  # one id each wherever they stand in a text
        kind = np.full(256, self._OTHER, np.uint8)
        kind[[9, 10, 13, 32]] = self._SPACE
        kind[[*range(97, 123), *range(0xDF, 0x100)]] = self._LETTER
        kind[48:58] = self._DIGIT
        self.kind = kind

    @staticmethod
    def _symbol(byte: int, last: bool) -> str:
        if 97 <= byte <= 122:
            return chr(byte - 32 if last else byte)
        return chr((0x200 if last else 0x100) + byte)

    @classmethod
    def of(cls, path: str, dtype: np.dtype) -> "WordRanks | None":
        """None for a vocabulary whose rules are not the ones stated here."""
        from tokenizers.models import BPE

        from .alignment import byte_alphabet

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normalizer, split = spec["model"], spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        steps = [x.get("type") for x in normalizer.get("normalizers", [])]
        patterns = [x["pattern"].get("Regex") for x in split.get("pretokenizers", []) if "pattern" in x]
        if steps != cls.NORMALIZERS or patterns != [cls.PATTERN] or model.get("end_of_word_suffix") != "</w>":
            return None
        alphabet = byte_alphabet()

        def spelled(piece: str) -> str:
            last = piece.endswith("</w>")
            codes = [alphabet[c] for c in (piece[:-4] if last else piece)]
            return "".join(cls._symbol(b, last and i == len(codes) - 1) for i, b in enumerate(codes))

        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        vocabulary = {spelled(piece): i for piece, i in model["vocab"].items() if i not in special}
        merges = [tuple(map(spelled, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        joined = [a + b for a, b in merges]
        single = [cls._symbol(b, last) for b in range(256) for last in (False, True)]
        if len(set(joined)) < len(joined) or len(vocabulary) < len(single) or not vocabulary.keys() >= set(single):
            return None
        alone = BPE(vocab=vocabulary, merges=merges)
        # ranks: bytes, then symbols (two bytes unless a plain letter), then merges in their order
        ranks = {bytes([b]): b for b in range(256)}
        ids = np.zeros(256 + 512 + len(joined), dtype)
        for i, text in enumerate([*single, *joined], 256):
            if i >= 256 + 512 and len(alone.tokenize(text)) != 1:
                continue
            rank = ranks.setdefault(text.encode(), i)
            ids[rank] = vocabulary[text]
        return cls(ranks, ids, list(special.values()))

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text, None for texts with other characters, a special
        token or a word of over ``LONGEST`` bytes."""
        out: list[bytes | None] = [None] * len(texts)
        plain = [
            i for i, t in enumerate(texts) if self._PLAIN.fullmatch(t) and not any(x in t for x in self.special)
        ]
        raw = [texts[i].lower().encode("latin-1") for i in plain]
        if not raw:
            return out
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        begin = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(r) + 1 for r in raw], out=begin[1:])
        kind = self.kind[data]
        # data ends in a space, so every character has a follower
        last = np.append(kind[1:] != kind[:-1], True) | (kind == self._DIGIT)
        self._contractions(data, kind, last)
        keep = kind != self._SPACE
        wide = data >= 0x80
        width = keep.astype(np.int64) + wide
        stop = np.cumsum(width)
        codes = np.zeros(int(stop[-1]), np.uint16)
        letter = (data >= 97) & (data <= 122)
        byte = data.astype(np.uint16) - np.where(wide, 0x40, 0).astype(np.uint16)  # the last UTF-8 byte
        final = np.where(letter, byte - 32, byte + 0x200)
        inner = np.where(letter, byte, byte + 0x100)
        codes[stop[keep] - 1] = np.where(last, final, inner)[keep]
        codes[stop[wide] - 2] = 0x100 + 0xC3
        ends = stop[keep & last]
        cut = np.concatenate([[0], stop])[begin]
        too_long = np.zeros(len(raw), bool)
        long = np.flatnonzero(np.diff(ends, prepend=0) > self.LONGEST)
        too_long[np.searchsorted(cut, ends[long], "left") - 1] = True
        text = codes.tobytes().decode("utf-16-le")
        merge = self.merger.encode_ordinary
        for n, i in enumerate(plain):
            if not too_long[n]:
                out[i] = self.ids[merge(text[cut[n] : cut[n + 1]])].tobytes() if cut[n] < cut[n + 1] else b""
        return out

    def _contractions(self, data: np.ndarray, kind: np.ndarray, last: np.ndarray) -> None:
        """An apostrophe that begins a run of other characters is one word with a
        following s, t, m, d, re, ve or ll."""
        at = np.flatnonzero((data == ord("'")) & last)
        at = at[(at == 0) | (kind[at - 1] != self._OTHER)]
        one, two = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
        short = np.isin(one, list(b"stmd"))
        pair = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        last[at[short | pair]] = False
        last[at[short] + 1] = True
        last[at[pair] + 2] = True


@lru_cache(maxsize=1)
def encoder(path: str, by_word: bool = True) -> Encoder:
    """One encoder a Python worker, kept over its tasks."""
    return Encoder(path, by_word)


def token_lengths(docs: DataFrame, vocabulary: str | None = None, by_word: bool = True) -> DataFrame:
    """(n_tokens) per row of ``docs``; a null text counts as empty."""
    prepare(docs.sparkSession)
    path = vocabulary or vocabulary_path()

    def lengths(batches: Batches) -> Batches:
        enc = encoder(path, by_word)
        for b in batches:
            n = [len(x) // enc.dtype.itemsize for x in enc.encode(texts_of(b))]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n_tokens"])

    return docs.select(text_or_empty().alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per encoded length ``n_tokens`` that occurs: ``n_docs``, and
    by suffix sums over all lengths: ``docs_at_least`` and ``tokens_at_least``
    (documents that long or longer), ``truncated_total`` (tokens left if every
    document is cut to this length), ``total_docs``, ``total_tokens`` and
    ``quantile`` (share of documents up to this length).

    Suffix sums run per block of 1,024 lengths; the blocks' totals (one row
    each) are summed on their own, so no task sees the whole histogram.  An empty
    table gives no rows; null and empty texts count with length 0."""
    # written, since two branches read it and encoding is the dear part
    h = materialise(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths").withColumn(
        "block", F.floor(F.col("n_tokens") / F.lit(BLOCK))
    )
    tokens = F.col("n_docs") * F.col("n_tokens")
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    every = Window.partitionBy(F.lit(0)).orderBy(F.desc("block"))
    whole = Window.partitionBy(F.lit(0))
    above = blocks.select(
        "block",
        (F.sum("d").over(every) - F.col("d")).alias("d_above"),
        (F.sum("t").over(every) - F.col("t")).alias("t_above"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    n, total = F.col("n_tokens"), F.col("total_docs")
    return (
        h.withColumn("d_in", F.sum("n_docs").over(inside))
        .withColumn("t_in", F.sum(tokens).over(inside))
        .join(above, "block")
        .select(
            n,
            "n_docs",
            (F.col("d_in") + F.col("d_above")).alias("docs_at_least"),
            (F.col("t_in") + F.col("t_above")).alias("tokens_at_least"),
            "total_docs",
            "total_tokens",
        )
        .withColumn("truncated_total", F.col("total_tokens") - F.col("tokens_at_least") + n * F.col("docs_at_least"))
        .withColumn("quantile", (total - F.col("docs_at_least") + F.col("n_docs")) / total)
    )


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: documents kept whole, documents cut and the
    tokens left after cutting, from the histogram alone."""
    n, docs = F.col("n_tokens"), F.col("n_docs")

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0))

    rows = [
        F.struct(
            F.lit(int(x)).cast("long").alias("context_limit"),
            total(F.when(n <= x, docs)).alias("docs_whole"),
            total(F.when(n > x, docs)).alias("docs_cut"),
            total(F.least(n, F.lit(int(x))) * docs).alias("tokens_left"),
        )
        for x in limits
    ]
    return histogram.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
