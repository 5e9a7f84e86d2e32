"""Operators 1, 3, 7 and 9."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from auditmart.llm import common, decontamination, secret_scan, toxicity, url_filter

WORDS = "the of and with river stone paper garden window table morning evening yellow quiet market letter".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


# --- toxicity ----------------------------------------------------------------------------


def toxic_world(n=240):
    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(rnd, 40)
        if bad:
            for _ in range(3):
                text += f". you {rnd.choice(WORDS)} {rnd.choice(['grobnik', 'snarvel'])} {prose(rnd, 3)}"
        docs.append((i, text))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_finds_held_out_documents(spark, docs_of):
    docs, labels = toxic_world()
    label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    extra = [(9001, None), (9002, ""), (None, docs[0][1]), (9003, "x " * 50_000)]
    table = docs_of(docs + extra + [docs[0]])
    rows = toxicity.score_documents(table, label_table).collect()
    assert len(rows) == len(docs) + len(extra) + 1
    truth = {d: t for d, _, t in labels}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"]:
            assert r["predicted"] == truth.get(r["doc_id"], 0)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[9001]["score"] == by_id[9002]["score"] and by_id[9001]["predicted"] == 0
    assert by_id[None]["predicted"] == 1 and not by_id[None]["held_out"]
    kept = toxicity.drop_toxic(table, label_table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, t in truth.items() if not t} | {9001, 9002, 9003}
    assert toxicity.score_documents(table.limit(0), label_table).count() == 0
    # without labels nothing is toxic
    none = toxicity.score_documents(table, label_table.limit(0)).collect()
    assert not any(r["predicted"] for r in none)


def test_grammar_weighs_clauses():
    s = toxicity.Scorer({"snarvel": 2.0, "grob*": 1.0})
    plain = s.clause("a snarvel".split())
    assert s.clause("you snarvel".split()) > plain > s.clause("not a snarvel".split())
    assert s.clause("he said snarvel".split()) != plain
    assert s.clause("kill them".split()) > 0 == s.clause("kill time".split())
    assert s.features("snarvels and unsnarvel") == (0, 0, 0, 0)  # whole words only
    assert s.features("grobnik. fine, grobbed")[2] == pytest.approx(1.0986, abs=1e-3)


def slow_features(scorer, text):
    """Every clause cut at the separators, every word of it looked up."""
    text, scores = text.lower(), []
    stems = {w.rstrip("*"): w.endswith("*") for w in [*scorer.insults, *toxicity.THREAT]}
    for clause in re.split(r"[.,;:!?\n]", text):
        runs = re.findall(r"\w+", clause)
        if any(r == w or (stem and r.startswith(w)) for r in runs for w, stem in stems.items()):
            score = scorer.clause(re.findall(r"\w+(?:'\w+)?", clause))
            scores += [score] if score > 0 else []
    length = math.log1p(len(text)) if scores else 0.0
    return math.log1p(sum(scores)), max(scores, default=0.0), math.log1p(len(scores)), length


def test_clause_features_against_every_clause():
    rnd = random.Random(12)
    scorer = toxicity.Scorer({"snarvel": 2.0, "grob*": 1.0})
    parts = "snarvel grobnik grob you not said kill them they're river x snarvels unsnarvel Ü42".split()
    for _ in range(400):
        text = "".join(rnd.choice(parts) + rnd.choice([" ", " ", " ", ". ", ",", "!?", "\n", " - "]) for _ in range(rnd.randrange(30)))
        assert scorer.features(text) == pytest.approx(slow_features(scorer, text))


@pytest.mark.parametrize("end", [". ", " "])
def test_long_texts_are_scored_in_linear_time(end):
    scorer = toxicity.Scorer({"snarvel": 2.0})
    text = (f"you are a snarvel and so on{end}") * 150_000  # over 4 MB, six separators never occur
    before = time.process_time()
    found = scorer.features(text)
    assert found[2] == pytest.approx(math.log1p(150_000 if end == ". " else 1))
    assert time.process_time() - before < 10


# --- decontamination -----------------------------------------------------------------------


def brute_overlap(doc, item, need):
    """Longest run on any diagonal with at least 80 % equal words."""
    best = 0
    for d in range(-len(item) + 1, len(doc)):
        for i in range(len(item)):
            same = 0
            for j in range(i, len(item)):
                if not 0 <= j + d < len(doc):
                    break
                same += doc[j + d] == item[j]
                if same >= 0.8 * (j - i + 1):
                    best = max(best, j - i + 1)
    return best >= need


def test_overlaps_against_brute_force(spark, docs_of):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    items = [(k, text(rnd.choice([6, 15, 30]))) for k in range(6)] + [(7, ["w1"])]
    docs = []
    for d in range(40):
        words, kind = text(60), d % 4
        item = items[d % 6][1]
        if kind == 1:
            words[20:20] = item
        if kind == 2:
            part = list(item[: max(14, len(item) // 2)])
            part[len(part) // 2] = "changed"
            words[5:5] = part
        if kind == 3:
            words[5:5] = item[:4]
        docs.append((d, words))
    table = docs_of([(d, " ".join(w)) for d, w in docs] + [(None, " ".join(items[1][1])), (50, None), (51, "")])
    bench = spark.createDataFrame([(k, " ".join(w).upper()) for k, w in items] + [(8, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(table, bench).collect()}
    for d, words in docs:
        for k, item in items[:6]:
            clear = brute_overlap(words, item, min(13, len(item)))
            if words[20 : 20 + len(item)] == item:
                assert (d, k) in got
            if (d, k) in got:
                assert clear
    assert (None, 1) in got and not any(d in (50, 51) for d, _ in got)
    kept = decontamination.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    hit = {d for d, _ in got}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([d for d, _ in docs if d not in hit] + [50, 51])
    assert decontamination.contaminated(table, bench.limit(0)).count() == 0
    assert decontamination.contaminated(table.limit(0), bench).count() == 0


def test_every_overlap_with_changed_words_is_found():
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]

    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    items, docs = [], []
    for n in (5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 18, 20, 25, 30, 40):
        for changed in range(1, n // 5 + 1):
            for _ in range(25):
                item = text(n)
                part = list(item)
                for i in rnd.sample(range(n), changed):
                    part[i] = "changed"
                items.append(item)
                docs.append(text(10) + part + text(10))
    threes = text(15)
    items.append(threes)
    docs.append(text(4) + [w if i not in (3, 7, 11) else "changed" for i, w in enumerate(threes)] + text(4))
    index = decontamination.Index(list(range(len(items))), [" ".join(w) for w in items], decontamination.MASKS)
    found = {(t, i): r for t, i, *r in index.overlaps(common.Words([" ".join(w) for w in docs]))}
    for k, (doc, item) in enumerate(zip(docs, items)):
        need = min(13, len(item))
        assert brute_overlap(doc, item, need)
        start, item_start, span, matched = found[k, k]
        same = [x == y for x, y in zip(doc[start : start + span], item[item_start : item_start + span])]
        assert span >= need and len(same) == span and sum(same) == matched >= 0.8 * span
    for t, i in found:
        assert brute_overlap(docs[t], items[i], min(13, len(items[i])))


def test_benchmark_in_blocks_gives_the_same(spark, docs_of, monkeypatch):
    rnd = random.Random(4)
    items = [(k, prose(rnd, 20)) for k in range(9)]
    docs = docs_of([(k, prose(rnd, 10) + " " + t) for k, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontamination.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 50)
    assert sorted(map(tuple, decontamination.contaminated(docs, bench).collect())) == whole and len(whole) >= 9


# --- secrets ---------------------------------------------------------------------------------


def secret_world(n=120):
    rnd = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    rows, truth = [], {}
    for i in range(n):
        key = "AKIA" + "".join(rnd.choice(alphabet) for _ in range(16))
        pw = "".join(rnd.choice("0123456789abcdef") for _ in range(18))
        card = "".join(rnd.choice("0123456789") for _ in range(16))
        text = [prose(rnd, 8), f"{key} {prose(rnd, 4)}", f"password={pw} {prose(rnd, 4)}", f"{card} {prose(rnd, 3)}",
                f"mail.{i:04d}@host{i}.example.com", f"see /usr/local/share/doc{i:08d}/readme.txt"]
        keep = [text[0], text[1 + i % 5]]
        rows.append((i, " ".join(keep)))
        truth[i] = {1: key, 2: pw}.get(1 + i % 5)
    return rows, truth


def test_secrets_found_and_false_positives_removed(spark, docs_of):
    rows, truth = secret_world()
    table = docs_of(rows + [(900, None), (901, ""), (None, rows[0][1]), (902, "word " * 30_000)])
    found = secret_scan.scan(table).collect()
    texts = dict(rows)
    right = wrong = 0
    for r in found:
        if r["doc_id"] in truth:
            assert texts[r["doc_id"]][r["start"] : r["end"]] == r["value"]
            if r["held_out"]:
                good = r["is_secret"] == (r["value"] == truth[r["doc_id"]])
                right, wrong = right + good, wrong + (not good)
    assert right >= 15 and wrong == 0  # held-out accuracy
    assert {r["doc_id"] for r in found if r["is_secret"]} == {d for d, v in truth.items() if v} | {None}
    masked = secret_scan.redact(table.withColumn("n_chars", F.length("text").cast("long")))
    out = {r["doc_id"]: r for r in masked.collect()}
    assert len(out) == table.count() and masked.columns == [*table.columns, "n_chars"]
    for d, v in truth.items():
        assert out[d]["text"] == (texts[d].replace(v, "<secret>") if v else texts[d])
        assert out[d]["n_chars"] == len(out[d]["text"])
    assert out[900]["text"] is None and out[901]["text"] == ""
    assert secret_scan.scan(table.limit(0)).count() == 0


def test_whole_value_after_a_credential_word_is_a_candidate(spark, docs_of):
    for text, value in (
        ('password = "SuperSecretPass" x', "SuperSecretPass"), ("passphrase: correct-horse-bat", "correct-horse-bat"),
        ("a secret=ab12x, then", "ab12x"), ('pwd = "k9!Tz$w2Qp#x"', "k9!Tz$w2Qp#x"), ("PASSWORD=P@ssw0rd!2024 b", "P@ssw0rd!2024"),
        ('{"db_password": "two words!", "n": 1}', "two words!"), ("'token' => 'a\\'b'", "a\\'b"), ("<p>pwd=x&y#1</p>", "x&y#1"),
        ('{"secret":12,"user":"bob"}', "12"), ('a "password=zz9" b', "zz9"),
    ):
        spans = list(secret_scan.candidates(text))
        assert [text[a:b] for a, b in spans] == [value], text
        assert secret_scan.rule_label(value, text[: spans[0][0]]) in (1, None)
    key = "AKIA" + "Q7" * 8
    text = f'note secret: "the key {key} is old" password=abc{key} {key}'
    assert [text[a:b] for a, b in secret_scan.candidates(text)] == [key, "abc" + key, key]
    assert not list(secret_scan.candidates("the secretary: Bob, tokens = many, password:"))
    rows, _ = secret_world()
    rows += [(500, "login password=P@ssw0rd!2024 here"), (501, 'set pwd = "k9!Tz$w2Qp#x" now'), (502, 'password = "SuperSecretPass" x')]
    out = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs_of(rows)).collect()}
    assert out[500] == "login password=<secret> here" and out[501] == 'set pwd = "<secret>" now'
    assert out[502] == 'password = "<secret>" x'


# --- url filter --------------------------------------------------------------------------------


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule, _ in url_filter.RULES:
        domain, prefix = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix):
            if best is None or len(rule) > len(best):
                best = rule
    return host, path, best


def test_url_rules_and_bayes(spark, sf):
    urls = [
        "http://a.NET/x", "https://www.example.net/en/1?q#f", "https://example.net/EN/", "http://net", "http://net/",
        "http://example.com/de/a", "http://badexample.com/de/a", "ftp://x.org/fr/", "http://org/fr", None, "", "no-scheme/x",
        "http://host?q=/net/", "http://a.b://c.net/x", "x://ÄB.org/fr/ü#/", "http://" + "a" * 300 + ".com/" + "b" * 5000,
        "http://cheappills.example.com/en/1", "http://spam-farm.example.org/a", "http://www.riverstone.example.com/en/2",
    ]
    urls += [f"http://cheappills{i}.example.com/buy/{i}" for i in range(20)]
    urls += [f"http://riverstone.example.com/read/{i}" for i in range(40)]
    pages = [(i, u, "<p>river stone cheap pills river</p>") for i, u in enumerate(urls)] + [(0, urls[0], None), (None, urls[1], "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("clash"))
    rows = url_filter.judge(table).collect()
    assert len(rows) == len(pages)
    verdicts = dict(url_filter.RULES)
    for r in rows:
        if r["page_id"] is None:
            continue
        assert (r["host"], r["path"], r["rule"]) == brute_url(urls[r["page_id"]]), urls[r["page_id"]]
        if r["rule"]:
            assert r["verdict"] == verdicts[r["rule"]]
        elif "cheappills" in r["host"] or "spam" in r["host"]:
            assert r["verdict"] == "block"
        elif "riverstone" in r["host"]:
            assert r["verdict"] == "allow"
    assert url_filter.judge(table.limit(0)).count() == 0


def test_url_joins_are_never_broadcast(spark, monkeypatch):
    """Sides of a join are many times larger than the files that Spark judges them by."""
    write, plans = url_filter.materialise, []

    def run(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())  # the final plan
        return rows

    def recorded(df, purpose):
        run(df)
        return write(df, purpose)

    monkeypatch.setattr(url_filter, "materialise", recorded)
    urls = [f"http://{'cheappills' if i % 3 else 'riverstone'}{i}.example.com/buy/{i}" for i in range(60)]
    table = spark.createDataFrame([(i, u, "<p>river stone cheap pills</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
    try:
        rows = run(url_filter.judge(table))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r["page_id"]: r["verdict"] for r in rows} == {i: "block" if i % 3 else "allow" for i in range(60)}
    assert sum("SortMergeJoin" in p for p in plans) >= 4  # or no plan was seen
    assert not [p for p in plans if "Broadcast" in p]


def test_viterbi_splits_concatenated_names(spark):
    names = spark.createDataFrame([("cheappills",), ("riverstone",), ("zzq",), ("x" * 100,)], "name string")
    counts = spark.createDataFrame([("cheap", 50), ("pills", 40), ("river", 9), ("stone", 9), ("riv", 2)], "word string, n long")
    got = {r["name"]: r["words"] for r in url_filter.segment(names, counts).collect()}
    assert got["cheappills"] == ["cheap", "pills"] and got["riverstone"] == ["river", "stone"]
    assert "".join(got["zzq"]) == "zzq" and got["x" * 100] == ["x" * 100]
