"""Operator 13."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from auditmart.llm import alignment, queries
from auditmart.llm.tokens import vocabulary_path


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def brute(docs, libraries):
    """Rows by definition: byte spans of all tokens, cut where both end."""
    a_lib, b_lib = libraries
    alphabet = alignment.byte_alphabet()
    groups_of, rows = [], []
    for _, text in docs:
        groups = []
        if text:
            a = a_lib.encode(" " + text, add_special_tokens=False).ids
            b = b_lib.encode(text)
            a_bytes = [bytes(alphabet[c] for c in a_lib.id_to_token(i)) for i in a]
            b_bytes = []
            for i in b:
                p = b_lib.id_to_piece(i)
                b_bytes.append(bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode())
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():

                def ends(pieces):
                    out, at = [], 0
                    for p in pieces:
                        at += len(p)
                        out.append(at)
                    return out

                ea, eb = ends(a_bytes), ends(b_bytes)
                done_a = done_b = 0
                for cut in sorted(set(ea) & set(eb)):
                    to_a, to_b = ea.index(cut, done_a) + 1, eb.index(cut, done_b) + 1
                    groups.append((a[done_a:to_a], b[done_b:to_b]))
                    done_a, done_b = to_a, to_b
        groups_of.append(groups)
    links = [Counter((x, y) for ga, gb in groups for x in ga for y in gb) for groups in groups_of]
    held = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for (doc_id, _), groups, found in zip(docs, groups_of, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        rows.append((
            doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in found.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "", text,
        ))
    return rows


def corpus():
    rnd = random.Random(8)
    words = ["the", "Tokenizer", "naïve", "übergroß", "日本語", "🤦🏼‍♂️", "don't", "x1234567", "  ", "\n", "<|endoftext|>", "<s>", "á", "\t"]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 40)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " "), (103, "  two  spaces  "), (104, "a▁b"), (105, "x" * 60_000), (106, "the " * 20_000)]
    docs += [(107, "▁"), (None, "the naïve"), (3, docs[3][1]), (3, docs[3][1]), (108, "日本語" * 900), (109, " no​break\x00null")]
    return docs


def test_alignment_equals_brute_force(spark, docs_of, libraries, monkeypatch):
    docs = corpus()
    expected = brute(docs, libraries)
    # several lanes, and workers that forget their windows
    monkeypatch.setattr(alignment, "LANE_PAIRS", 150)
    got = alignment.align_documents(docs_of(docs).repartition(3), keep_groups=True)
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    zero = {r["doc_id"]: r for r in alignment.align_documents(docs_of(docs)).where("n_a = 0").collect()}
    assert set(zero) >= {100, 101, 104, 107}
    assert all(r["groups_sha256"] == "" and r["n_links"] == r["count_sum"] == 0 for r in zero.values())
    assert alignment.align_documents(docs_of(docs).limit(0)).count() == 0


def test_memory_is_bounded_and_forgetting_changes_nothing(libraries, monkeypatch):
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    texts = [t or "" for _, t in corpus()]
    kept = alignment.Aligner(*paths)
    whole = kept.align(texts)
    monkeypatch.setattr(alignment, "MEMO_TOKENS", 10)
    small = alignment.Aligner(*paths)
    for t, expected in zip(texts, whole):
        (got,) = small.align([t])
        assert got[:5] == expected[:5]
        assert got[5].tolist() == expected[5].tolist() and got[6].tolist() == expected[6].tolist()
    assert len(small.known) < len(kept.known)


def test_pair_counts(spark, docs_of):
    made = alignment.lanes(docs_of([(1, "the cat"), (2, "the the"), (3, "a cat")]))
    n_b = alignment._piece_count(vocabulary_path("piece_bpe_32k.model"))
    rows = alignment.pair_counts(made, n_b).collect()
    assert sorted(r["n_docs"] for r in rows) == [1, 2, 2] and all(r["best"] for r in rows)


def test_query_equals_brute_force(spark, sf, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_token_alignment"](spark, sf)
    assert Counter(map(tuple, got.collect())) == Counter(r[:-1] for r in brute(docs, libraries))
