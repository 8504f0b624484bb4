"""Text operators against brute force, on whole tables and on edge rows."""

import hashlib
import re
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cofan.llm import bpe, content_sort_dedup, jaccard_join, language, mixing, pii, queries, toxicity

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
#: Null and empty texts, white space only, ties, repeated rows, very long text.
EDGE = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two three four five six"), (5, "One two  three four FIVE six"),
    (5, "One two  three four FIVE six"), (6, "short text"), (7, "SHORT\ttext"), (8, LONG), (9, LONG + " tail"),
    (10, "<|endoftext|> ΣΑΣ naïve\u00a0cafe\u0301 12.34"), (11, "mail a.b@c.example or a@b@c.de, ip 1.2.3.4 256.1.1.1.9.9"),
    (12, "card 4111 1111 1111 1111, 4111111111111112 phone +49 (30) 1234-567 +1 2 http://x.example/a iban: DE44500105175407324931"),
    (None, "one two three four five six"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """The edge rows with extra columns whose names clash with working columns."""
    schema = "doc_id long, text string, id string, n int, rest string, tokens string, digest string, source string, lang string"
    rows = [(i, t, "x", 1, "r", "t", "d", "s" if k % 2 else None, None) for k, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, schema).repartition(4)


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    holders = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            holders[s].append(i)
    for a, b in {(x, y) for own in holders.values() for k, x in enumerate(own) for y in own[k + 1 :]}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def joined(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.annotate(df).collect()}


def test_jaccard_documents(spark):
    df = documents(spark)
    assert joined(df) == brute_components(texts(df))


def test_jaccard_edges(spark, edge):
    df = edge.filter("doc_id IS NOT NULL")
    assert joined(df) == brute_components(texts(df))
    assert jaccard_join.annotate(df).count() == df.count()
    assert jaccard_join.annotate(df.limit(0)).count() == 0


def test_jaccard_chains_and_unlinked_members(spark, monkeypatch):
    """One hot shingle list whose members link in chains, over many small blocks."""
    for name, value in (("HOT", 2), ("BLOCK", 3), ("WIDE", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    passage = [f"p{k}" for k in range(14)]
    rows = []
    for g in range(6):
        base = passage + [f"g{g}w{k}" for k in range(12)]
        rows += [(100 * g + c, " ".join(base[c : c + 24] + [f"t{g}"] * (c % 2))) for c in range(3)]
    rows += [(900 + k, " ".join(passage[k:])) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert joined(df) == brute_components(rows)


def brute_links(rows):
    """Every pair of documents that is similar enough."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("block", [2, 512])
def test_jaccard_counts_every_link(spark, edge, monkeypatch, block):
    """Groups of different near copies, with exact copies, over one and many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    base = [f"b{k}" for k in range(60)]
    rows = [(10 * k, " ".join(base[:60 - k] + [f"x{k}"] * (k % 3))) for k in range(14)]
    rows += [(10 * k + 1, t.upper()) for k, (_, t) in enumerate(rows[:4])] + [(500, rows[5][1]), (501, rows[5][1])]
    rows += [(600, ""), (601, "alone")]
    want = brute_links(rows)
    df = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.n_links for r in jaccard_join.annotate(df).collect()}
    assert got == {i: sum(i in pair for pair in want) for i, _ in rows}
    # Between classes: by the smallest id of each.
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    low = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    found = [tuple(r) for r in jaccard_join.links(df).collect()]
    assert sorted(found) == sorted({tuple(sorted((low[a], low[b]))) for a, b in want} - {(low[a], low[a]) for a, _ in want})
    assert len(found) > 30


def test_jaccard_links_of_documents(spark):
    df = documents(spark)
    want = brute_links(texts(df))
    got = {r.doc_id: r.n_links for r in jaccard_join.annotate(df).collect()}
    assert got == {i: sum(i in pair for pair in want) for i, _ in texts(df)}


def test_jaccard_keeps_one_of_each_component(spark, edge):
    df = edge.filter("doc_id IS NOT NULL")
    want = {i for i, (_, c) in brute_components(texts(df)).items() if i == c}
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want


@pytest.mark.parametrize("whole", [True, False])
def test_bpe_equals_the_library(spark, edge, whole):
    df = documents(spark) if whole else edge
    own = Tokenizer.from_file(VOCABULARY)
    got = sorted(map(str, bpe.digests(df, VOCABULARY).select("n_tokens", "ids_sha256", "decoded_sha256").collect()))
    want = []
    for _, t in texts(df):
        ids = own.encode(t, add_special_tokens=False).ids
        said = [" ".join(map(str, ids)), own.decode(ids, skip_special_tokens=False)]
        want.append(T.Row(n_tokens=len(ids), ids_sha256=hashlib.sha256(said[0].encode()).hexdigest(), decoded_sha256=hashlib.sha256(said[1].encode()).hexdigest()))
    assert got == sorted(map(str, want))
    assert bpe.digests(df.limit(0), VOCABULARY).count() == 0


def test_exact_dedup_edges(spark, edge):
    rows = [r for r in texts(edge) if r[0] is not None]
    df = edge.filter("doc_id IS NOT NULL")
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    want = sorted((i, min(g)[1], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, i in g)
    got = content_sort_dedup.annotate(df).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    kept = content_sort_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(min(g)[1] for g in groups.values())
    assert content_sort_dedup.annotate(df.limit(0)).count() == 0


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m)]


@pytest.mark.parametrize("whole", [True, False])
def test_personal_data_equals_plain_patterns(spark, edge, whole):
    df = documents(spark) if whole else edge
    want = []
    for i, t in texts(df):
        s = base_spans(t)
        n = [sum(x[0] == k for x in s) for k in ("email", "ip", "card", "phone")]
        want.append((str(i), *n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()))
    got = pii.find(df).collect()
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
    assert pii.find(df.limit(0)).count() == 0


def test_personal_data_method_spans(edge):
    said = {r.doc_id: r.spans for r in pii.find(edge).collect()}[12]
    assert "url:" in said and "account:" in said and "card:" in said


def code_length(text, samples):
    """Bits of ``text`` by escapes over plain dictionaries."""
    from math import log2

    counts = defaultdict(lambda: defaultdict(int))
    for s in samples:
        for n in range(language.ORDER + 1):
            for k in range(len(s) - n):
                counts[s[k : k + n]][s[k + n]] += 1
    bits = 0.0
    for k, byte in enumerate(text):
        for n in range(min(language.ORDER, k), -2, -1):
            if n < 0:
                bits += 8
                break
            seen = counts.get(text[k - n : k])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if byte in seen:
                bits += log2(total / seen[byte])
                break
            bits += log2(total / len(seen))
    return bits


def test_language_code_lengths(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("le chat est là", "fr"), ("and then the end", "en"), ("ça va", "fr"), (None, "en"), ("x", None)])]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["en", "fr"]
    tests = ["the chat", "là", "q", "", "zebra ☃ the cat and the chat est là" * 3]
    got = model.lengths([t.encode() for t in tests])
    for t, bits in zip(tests, got):
        for lang, b in zip(model.langs, bits):
            assert b == pytest.approx(code_length(t.encode(), [x.encode() for _, x, y in rows if y == lang and x]), rel=1e-9, abs=1e-9)


def test_language_held_out_accuracy_and_edges(spark, edge):
    got = queries.op7_language_id(spark, "/root/testdata/sf0.01").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").filter("lang IS NOT NULL")
    assert got.filter("lang = lang_pred").count() > 0.97 * got.count()
    model = language.learn(edge)  # no language is known
    assert {(r.lang_pred, r.score) for r in language.predict(edge, model).collect()} == {("und", 0.0)}
    known = language.learn(documents(spark))
    rows = {r.doc_id: r.lang_pred for r in language.predict(edge, known).collect()}
    assert rows[1] == rows[2] == rows[3] == "und" and rows[8] in known.langs


def test_toxicity_held_out_and_edges(spark, edge):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out AND toxic IS NOT NULL")
    right = got.filter("predicted = toxic").count()
    assert right > 0.8 * got.count()
    none = toxicity.learn(edge, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-9 for r in toxicity.score(edge, none).collect())


def test_toxicity_misspelling():
    clean = [["good", "day", f"a{k}"] for k in range(60)]
    bad = [["good", "idiot", f"b{k}"] for k in range(20)]
    model = toxicity.train(clean + bad, [0] * 60 + [1] * 20)
    idiot, other = model.scores(["what an idiots", "what a day"])
    assert idiot > other and model.scores([""])[0] == 0


def test_mixing_budget_and_passes(spark):
    df = documents(spark)
    words = df.select("source", "doc_id", mixing.token_count(F.col("text")).alias("n"))
    shown = mixing.mix(df, max_repeats=2.0)
    assert {r.doc_id for r in shown.select("row.doc_id").collect()} == {r.doc_id for r in df.select("doc_id").collect()}
    total = {r.source: r.n for r in words.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    longest = {r.source: r.n for r in words.groupBy("source").agg(F.max("n").alias("n")).collect()}
    used = {r.source: r.n for r in shown.select("row.source", mixing.token_count(F.col("row.text")).alias("n")).groupBy("source").agg(F.sum("n").alias("n")).collect()}
    for s in total:
        assert total[s] <= used[s] <= 2 * total[s] + longest[s]
    # An entropy that only equal weights reach, and a budget.
    even = mixing.mix(df, target_entropy=100.0, budget_tokens=10 * len(total))
    assert 0 < even.count() < df.count() + len(total)


def test_mixing_token_count_and_edges(spark, edge):
    got = {r.doc_id: r.n for r in edge.select("doc_id", mixing.token_count(F.col("text")).alias("n")).collect()}
    assert all(got[i] == len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts(edge))
    shown = mixing.mix(edge)
    assert shown.select("row.*").columns == edge.columns
    assert {r.doc_id for r in shown.select("row.doc_id").collect()} >= {i for i, _ in EDGE}
    assert mixing.mix(edge.limit(0)).count() == 0
