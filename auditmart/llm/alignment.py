"""Operator 13, cross-tokenizer alignment: which tokens of one vocabulary (A)
stand for which tokens of another (B).

Every text is first encoded whole by both tokenizers.  Where both let a token begin
with a space at the same byte, the text before it ends in both: these anchors cut
the document into short windows of token ids.  A window's alignment depends on its ids
alone, so it is worked out once and remembered by the two id tuples.

How many documents hold an id pair is a corpus-wide count.  Documents travel in
lanes of bounded size; a lane's distinct pairs are counted in its task, summed over
lanes, and the sums come back to each lane as one list in the order it asked in.
No pair of a single document is shuffled as a row of its own, and nothing whole
passes through the driver or one task."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import Counter
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, materialise, prepare, text_or_empty
from .tokens import vocabulary_path

A_VOCABULARY = "byte_bpe_50k.json"
B_VOCABULARY = "piece_bpe_32k.model"
MEMO_TOKENS = 4_000_000  # tokens in remembered windows; a worker starts anew beyond that
LANE_PAIRS = 1_000_000  # document pairs at which a lane is closed

DOC_TYPE = (
    "struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,"
    "groups_sha256:string,groups:string,n_pairs:bigint>"
)
LANE_SCHEMA = f"lane long, docs array<{DOC_TYPE}>, pairs binary, links binary, codes binary, holders binary"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the other bytes take the characters
    from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabularies:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        alphabet = byte_alphabet()
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        ranks = {
            bytes(map(alphabet.__getitem__, piece)): i for piece, i in spec["model"]["vocab"].items() if i not in special
        }
        # no special tokens: their strings inside a text are plain text
        self.a = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("A has no token for some byte, so it cannot spell every text")
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.a_bytes[i] = piece
        n = self.b.get_piece_size()
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(list(range(n))))
        ]
        # ids as 2 bytes where both vocabularies allow: shorter keys of windows
        self.dtype, self.code = ("<u2", "H") if max(n, len(self.a_bytes)) <= 1 << 16 else ("<u4", "I")
        self.a_length, self.a_space = self._sizes(self.a_bytes)
        self.b_length, self.b_space = self._sizes(self.b_bytes)

    @staticmethod
    def _sizes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([len(p) for p in pieces], np.int64), np.array([p[:1] == b" " for p in pieces], bool)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of space + text by A and of text by B (which adds the space); None for
        an empty text or one that either does not spell out byte by byte.  A never
        changes a byte (it has a token for each), so its length tells; B normalises, so
        its bytes are compared."""
        if not text:
            return None
        whole = (" " + text).encode("utf-8")
        b = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        a = np.array(self.a.encode_ordinary(" " + text), self.dtype)
        if int(self.a_length[a].sum()) != len(whole):
            return None
        return a, np.array(b, self.dtype)


class Aligner:
    """Aligns batches of texts, remembering windows by their id tuples."""

    def __init__(self, a_path: str, b_path: str):
        self.words = Vocabularies(a_path, b_path)
        self.n_b = len(self.words.b_bytes)
        lengths = self.words.a_length.tolist(), self.words.b_length.tolist()
        self.tools = (*lengths, *(list(map(str, range(len(x)))) for x in lengths), self.n_b)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[tuple[bytes, bytes], int] = {}
        self.text: list[str] = []
        self.groups, self.begin = array("q"), array("q", [0])
        self.codes, self.links = array("q"), array("q")
        self.tokens = 0

    def _learn(self, key: tuple[bytes, bytes]) -> int:
        """Align a new window: a group ends where A and B have spelt equally many bytes.  A
        pair may be listed more than once; its links are summed per text."""
        b = array(self.words.code, key[1])
        a_length, b_length, a_text, b_text, n_b = self.tools
        text: list[str] = []
        codes: list[int] = []
        ga: list[int] = []
        j = ahead = 0  # ahead: bytes of A beyond those of B
        from_b = 0
        for x in array(self.words.code, key[0]):
            ga.append(x)
            ahead += a_length[x]
            while ahead > 0:
                ahead -= b_length[b[j]]
                j += 1
            if ahead:
                continue
            if len(ga) == 1 == j - from_b:
                y = b[from_b]
                codes.append(x * n_b + y)
                text.append(a_text[x] + "|" + b_text[y])
            else:
                gb = b[from_b:j]
                text.append(",".join([a_text[x] for x in ga]) + "|" + ",".join([b_text[y] for y in gb]))
                if len(ga) * len(gb) <= 256:
                    codes += [x * n_b + y for x in ga for y in gb]
                else:
                    self._product(ga, gb)
            ga, from_b = [], j
        self.known[key] = at = len(self.text)
        self.text.append(";".join(text))
        self.groups.append(len(text))
        self.codes.extend(codes)
        self.links.extend([1] * len(codes))
        self.tokens += j + len(self.codes) - self.begin[-1]
        self.begin.append(len(self.codes))
        return at

    def _product(self, ga, gb) -> None:
        """The pairs of a long group, which has few different ids, with their numbers."""
        many_b = Counter(gb).items()
        for x, n in Counter(ga).items():
            for y, m in many_b:
                self.codes.append(x * self.n_b + y)
                self.links.append(n * m)

    def align(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """Per text: n_a, n_b, n_groups, n_links, the groups as a string, and its
        distinct pair codes (A id x size of B + B id, ascending) with their links."""
        if self.tokens > MEMO_TOKENS:
            self._forget()
        empty = np.zeros(0, np.int64)
        out = [(0, 0, 0, 0, "", empty, empty)] * len(texts)
        ids = [(i, e) for i, e in enumerate(map(self.words.encode, texts)) if e]
        if not ids:
            return out
        a, b = (np.concatenate([e[k] for _, e in ids]) for k in (0, 1))
        n_a, n_b = (np.array([len(e[k]) for _, e in ids]) for k in (0, 1))
        begin_a, begin_b = self._begins(a, self.words.a_length), self._begins(b, self.words.b_length)
        first = begin_a[np.cumsum(n_a) - n_a]  # byte at which each text begins, in both
        # the space before it makes each text's first tokens one of them
        anchors = np.intersect1d(begin_a[self.words.a_space[a]], begin_b[self.words.b_space[b]], assume_unique=True)
        windows = self._windows(a, b, np.searchsorted(begin_a, anchors), np.searchsorted(begin_b, anchors))
        doc = np.searchsorted(first, anchors, "right") - 1
        cuts = np.searchsorted(doc, np.arange(len(ids) + 1))
        groups = np.add.reduceat(np.frombuffer(self.groups, np.int64)[windows], cuts[:-1])
        keys, links = self._pairs(doc, windows)
        at = np.searchsorted(keys >> 32, np.arange(len(ids) + 1))
        n_links = np.add.reduceat(links, at[:-1])
        listed = windows.tolist()
        for d, (i, _) in enumerate(ids):
            text = ";".join(map(self.text.__getitem__, listed[cuts[d] : cuts[d + 1]]))
            mine = slice(at[d], at[d + 1])
            out[i] = (int(n_a[d]), int(n_b[d]), int(groups[d]), int(n_links[d]), text, keys[mine] & 0xFFFFFFFF, links[mine])
        return out

    @staticmethod
    def _begins(ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        n = length[ids]
        return np.cumsum(n) - n

    def _windows(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        raw_a, raw_b, known = a.tobytes(), b.tobytes(), self.known
        edges_a, edges_b = [*(at_a * a.itemsize).tolist(), len(raw_a)], [*(at_b * b.itemsize).tolist(), len(raw_b)]
        out = []
        for i, j, k, m in zip(edges_a, edges_a[1:], edges_b, edges_b[1:]):
            key = (raw_a[i:j], raw_b[k:m])
            w = known.get(key)
            out.append(self._learn(key) if w is None else w)
        return np.array(out, np.int64)

    def _pairs(self, doc: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text << 32 | code, ascending; links) of the distinct pairs of each text."""
        begin, codes, links = (np.frombuffer(x, np.int64) for x in (self.begin, self.codes, self.links))
        n = begin[windows + 1] - begin[windows]
        at = np.arange(n.sum()) + np.repeat(begin[windows] - (np.cumsum(n) - n), n)
        keys = (np.repeat(doc, n) << 32) | codes[at]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[new], np.add.reduceat(links[at][order], new)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner a Python worker, kept over its tasks."""
    return Aligner(a_path, b_path)


# --- lanes -------------------------------------------------------------------------


def _pack(x: np.ndarray, n: int) -> bytes:
    """Whole numbers as 2, 4 or 8 byte integers, whichever holds them all."""
    top = int(x.max()) if n else 0
    return x.astype("<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "<u2").astype(np.int64)


class _Lane:
    def __init__(self) -> None:
        self.docs: list[dict] = []
        self.codes: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, found, keep_groups: bool) -> None:
        n_a, n_b, n_groups, n_links, text, codes, links = found
        self.docs.append({
            "doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
            "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if n_a else "",
            "groups": text if keep_groups else None, "n_pairs": len(codes),
        })
        self.codes.append(codes)
        self.links.append(links)
        self.size += len(codes)

    def row(self, lane: int, schema: pa.Schema) -> pa.RecordBatch:
        codes, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        links = np.concatenate(self.links)
        holders = np.bincount(at, minlength=len(codes))  # a document names a pair once
        values = [lane, self.docs, _pack(at, self.size), _pack(links, self.size), codes.astype("<u8").tobytes(), _pack(holders, len(codes))]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)


def _lane_schema() -> pa.Schema:
    doc = pa.struct([
        *((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()), ("groups", pa.string()), ("n_pairs", pa.int64()),
    ])
    return pa.schema([
        ("lane", pa.int64()), ("docs", pa.list_(doc)),
        *((c, pa.binary()) for c in ("pairs", "links", "codes", "holders")),
    ])


def lanes(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep_groups: bool = False) -> DataFrame:
    """Encode and align every text of ``docs`` (doc_id, text) once; written.  A row is
    a lane of documents with about ``LANE_PAIRS`` pairs: ``docs`` (their digests, and
    their groups as strings with ``keep_groups``), ``pairs`` (positions of their
    pairs in ``codes``, document by document), ``links`` (occurrences of each),
    ``codes`` (the lane's distinct pairs, ascending) and ``holders`` (documents of the lane
    that hold each)."""
    spark = prepare(docs.sparkSession)
    paths = a_path or vocabulary_path(A_VOCABULARY), b_path or vocabulary_path(B_VOCABULARY)

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        schema = _lane_schema()
        number = TaskContext.get().partitionId() << 33
        align = aligner(*paths).align
        lane = _Lane()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for doc_id, found in zip(ids, align(texts)):
                lane.add(doc_id, found, keep_groups)
                if lane.size >= LANE_PAIRS:
                    yield lane.row(number, schema)
                    number, lane = number + 1, _Lane()
        if lane.docs:
            yield lane.row(number, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialise(rows.mapInArrow(run, LANE_SCHEMA), "alignment_lanes")


def _listed(lanes: DataFrame) -> DataFrame:
    """(lane, place, code, n): the distinct pairs of every lane and how many of its
    documents hold each."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            for lane, codes, holders in zip(*(c.to_pylist() for c in b.columns)):
                codes = np.frombuffer(codes, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(codes), lane), pa.int64()),
                        pa.array(np.arange(len(codes), dtype=np.int32)),
                        pa.array(codes),
                        pa.array(_unpack(holders, len(codes))),
                    ],
                    ["lane", "place", "code", "n"],
                )

    return lanes.select("lane", "codes", "holders").mapInArrow(run, "lane long, place int, code long, n long")


def pair_counts(lanes: DataFrame, n_b: int) -> DataFrame:
    """(code, n_docs, best, a_id, b_id): documents that hold each id pair linked, and
    whether no other pair of its A id is held by more.  Lanes are summed map-side; an A
    id has at most one row per B id."""
    counts = _listed(lanes).groupBy("code").agg(F.sum("n").alias("n_docs")).select(
        "code", "n_docs", F.expr(f"code div {n_b}").alias("a_id"), F.expr(f"code % {n_b}").alias("b_id")
    )
    most = F.max("n_docs").over(Window.partitionBy("a_id"))
    return counts.select("code", "n_docs", (F.col("n_docs") == most).alias("best"), "a_id", "b_id")


def _scored(lane: pa.Table, counts: pa.Table) -> Iterator[pa.RecordBatch]:
    place = counts.column("place").to_numpy()
    n_docs, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    n_docs[place] = counts.column("n_docs").to_numpy()
    best[place] = counts.column("best").to_numpy()
    for i in range(lane.num_rows):
        docs = lane.column("docs")[i].values
        n = docs.field("n_pairs").to_numpy()
        size = int(n.sum())
        pairs, links = (_unpack(lane.column(c)[i].as_py(), size) for c in ("pairs", "links"))
        ends = np.concatenate([[0], np.cumsum(n)])

        def total(x: np.ndarray) -> pa.Array:
            sums = np.concatenate([[0], np.cumsum(x)])
            return pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())

        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        yield pa.table(
            [*(docs.field(c) for c in names), total(links * best[pairs]), total(links * n_docs[pairs]),
             docs.field("groups_sha256"), docs.field("groups")],
            [*names, "n_best", "count_sum", "groups_sha256", "groups"],
        )


SCORED_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


def align_documents(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep_groups: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 and (with ``keep_groups``) groups, the alignment as
    ``a1,a2|b1;a3|b2``.

    Null and empty texts, and texts that the tokenizers do not spell byte by byte, have no
    tokens: zeros and ''.  A row is a document: repeated rows count each.  Extra
    columns are ignored; an empty table gives no rows.  A text is encoded whole in one
    task, however long; windows longer than the memory of known ones are not kept."""
    made = lanes(docs, a_path, b_path, keep_groups)
    n_b = _piece_count(b_path or vocabulary_path(B_VOCABULARY))
    counts = materialise(pair_counts(made, n_b).select("code", "n_docs", "best"), "alignment_counts")
    replies = _listed(made).select("lane", "place", "code").hint("merge").join(counts, "code").select("lane", "place", "n_docs", "best")
    asked = made.select("lane", "docs", "pairs", "links")

    def score(lane: pa.Table, reply: pa.Table) -> pa.Table:
        tables = list(_scored(lane, reply))
        return pa.concat_tables(tables)

    return asked.groupBy("lane").cogroup(replies.groupBy("lane")).applyInArrow(score, SCORED_SCHEMA)


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
