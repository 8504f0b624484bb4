"""More labelled languages than the former bound of 200."""

import tracemalloc

import numpy as np
import pytest

from cofan.llm import language
from tests.llm.test_texts import code_length


def test_every_labelled_language_is_learned(spark):
    word = lambda k: "".join(chr(0x4E00 + 16 * k + j) for j in range(6))
    rows = [(2 * k + c, f"{word(k)} {word(k)}", f"l{k:03}") for k in range(230) for c in range(2 if k < 200 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    model = language.learn(df)
    assert model.langs == sorted({r[2] for r in rows})
    assert language.predict(df, model).filter("lang_pred = lang").count() == len(rows)


def test_blocks_of_languages_and_windows_change_nothing(spark, monkeypatch):
    rows = [(k, f"{'abcdefg'[k]}a b{k} the {'xyzuvwq'[k] * 3} né", f"l{k}") for k in range(7)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = ["", "a", "the", "né né xxx", "☃ the xyz ba " * 9, "bbbb the vvv"]
    whole = model.lengths([t.encode() for t in tests])
    monkeypatch.setattr(language, "LANGS", 2)
    monkeypatch.setattr(language, "CHUNK", 7)
    for t, want in zip(tests, whole):
        assert np.allclose(model.lengths([t.encode()])[0], want, rtol=1e-12)
    for lang, want in zip(model.langs, whole[4]):
        assert want == pytest.approx(code_length(tests[4].encode(), [x.encode() for _, x, y in rows if y == lang]), rel=1e-9)


def test_the_model_holds_what_the_samples_hold(spark):
    """Languages without a common window add their own windows only."""
    texts = ["".join(chr(0x4E00 + 97 * k + j) for j in range(90)) for k in range(40)]
    model = language.learn(spark.createDataFrame([(k, t, f"l{k:02}") for k, t in enumerate(texts)], "doc_id long, text string, lang string"))
    assert sum(len(g.seen) for g in model.grams) <= sum((language.ORDER + 1) * len(t.encode()) for t in texts)


def test_bytes_that_are_not_utf8(spark):
    known = language.learn(spark.createDataFrame([(1, "the cat", "en"), (2, "le chat", "fr")], "doc_id long, text string, lang string"))
    df = spark.sql("SELECT 1L AS doc_id, cast(X'74686520FF636174' AS string) AS text UNION ALL SELECT 2L, cast(X'FFFE' AS string)")
    got = {r.doc_id: r.lang_pred for r in language.predict(df, known).select("doc_id", "lang_pred").collect()}
    assert got == {1: "en", 2: "und"}
    assert language.learn(df.selectExpr("doc_id", "text", "'en' AS lang")).langs == ["en"]


def test_scoring_takes_little_memory_beside_the_texts(spark):
    """The pipeline's language stage shares an executor's memory with the model of encode."""
    model = language.learn(spark.createDataFrame([(k, f"{x} the cat le chat", x * 3) for k, x in enumerate("abcd")], "doc_id long, text string, lang string"))
    batch = [b"the cat or le chat aaa bbb " * 400] * 200  # 2 MB
    model.lengths(batch)
    tracemalloc.start()
    try:
        model.lengths(batch)
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("windows, chunk", [(1, 1), (5, 8), (13, 8), (64, 4096)])
def test_texts_that_cross_blocks(spark, monkeypatch, windows, chunk):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur le tapis", "fr")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [b"", b"t", b"the cat", b"", b"le chat est sur the mat " * 3, b"abc", b"tapis", b""]
    alone = [model.lengths([t])[0] for t in texts]
    monkeypatch.setattr(language, "WINDOWS", windows)
    monkeypatch.setattr(language, "CHUNK", chunk)
    assert np.allclose(model.lengths(texts), alone, rtol=1e-12)
