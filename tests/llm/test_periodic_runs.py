"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import __spark_entry__
from cofan.llm import periodic_runs

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w):
    out = []
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            whole = (i, j + p - i)
            if j > i and whole[1] >= max(6, 4 * p) and whole not in [x[:2] for x in out]:
                out.append((*whole, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {k for start, size, p in runs for k in range(start + p, start + size)}
    return [x for k, x in enumerate(w) if k not in gone]


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def test_batches_equal_brute_force():
    rnd = random.Random(9)
    texts = []
    for _ in range(1500):
        letters, n = rnd.choice([1, 2, 3, 9]), rnd.choice([0, 1, 5, 6, 7, 40, 120])
        w = [rnd.randrange(letters) for _ in range(n)]
        while w and rnd.random() < 0.6:
            a, p = rnd.randrange(len(w)), rnd.randint(1, 1 + len(w) // 5)
            w = (w[:a] + w[a : a + p] * rnd.randint(2, 6) + w[a + p :])[:300]
        texts.append([str(x).encode() for x in w])
    for at in range(0, len(texts), 70):
        part = texts[at : at + 70]
        for w, (runs, left) in zip(part, periodic_runs.find_batch([b" ".join(w) for w in part])):
            assert runs == brute(w) and left == kept(w, runs)


def test_a_chance_meeting_of_fingerprints_changes_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_mixed", lambda left, right: (left + right) % 5)
    rnd = random.Random(3)
    w = [str(rnd.randrange(40)).encode() for _ in range(200)]
    w[60:100] = w[60:66] * 6 + w[60:64]
    runs, _ = periodic_runs.find_batch([b" ".join(w)])[0]
    assert runs == brute(w) and (60, 40, 6) in runs


def test_edges(spark):
    long = "a " * 40_000 + "b" * 100_000
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "a a a a a"), (5, "a\ta\na  a a a"), (5, "a\ta\na  a a a"), (6, "x y x y x y x y z"), (None, "é é é é é é"), (7, long), (8, "a a a a a a a")]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, collapsed string, n_words int")
    got = sorted(periodic_runs.find(df).collect(), key=lambda r: (r.doc_id or 0))
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: x[0] or 0)):
        w = words_of(t)
        want = [(0, 40_000, 1)] if i == 7 else brute(w)
        assert (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (i, len(w), want, " ".join(kept(w, want)))
    assert periodic_runs.find(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in __spark_entry__.queries()["op12_periodic_runs"](spark, SF).collect()}
    seen = 0
    for d in docs:
        w = planted(d.doc_id, words_of(d.text))
        runs = brute(w)
        seen += bool(runs)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        text = "".join("%d,%d,%d\n" % r for r in runs)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *top, None if not runs else 1000 * top[1] // top[2])
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(kept(w, runs)).encode()).hexdigest()
    assert len(got) == len(docs) and seen > 5
