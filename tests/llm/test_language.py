import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import SF_SMALL, sentence
from pyspark.sql import functions as F

from tessera.llm import language


def brute_vector(text):
    """One n-gram at a time."""
    out = np.zeros(language.DIMENSION, np.int64)
    low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in text]
    marks = [0, *[cp if c.isalpha() else 0 for c, cp in zip(text, low, strict=True)], 0]
    for i in range(1, len(marks) - 1):
        if marks[i]:
            v = np.ones(language.DIMENSION, np.int64)
            for back in range(3):
                v = v * np.roll(language.letter_vector(marks[i + 1 - back]).astype(np.int64), back)
            out += v
    return out


def test_vectors_equal_brute_force(rng, monkeypatch):
    texts = ["", "a", "Ab, aB!", "ÉTÉ été", "日本語 テスト", "İstanbul ß 12 x3", "...", sentence(rng, 80), "q" * 70]
    want = np.stack([brute_vector(t) for t in texts])
    for part in (language.SLICE, 7, 1):
        monkeypatch.setattr(language, "SLICE", part)
        for wide in (language.WIDE, 0):
            monkeypatch.setattr(language, "WIDE", wide)
            got, total = language.bundled(texts)
            assert (got == want).all()
            assert list(total) == [sum(c.isalpha() for c in t) for t in texts]


def test_held_out_accuracy(spark):
    rows = language.op11_language(spark, SF_SMALL).join(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_equals_brute_force_on_a_small_table(spark, documents, rng):
    kinds = {"en": "the of and ing", "de": "der und ich sch", "es": "los que ción del"}
    texts, langs = [], []
    for i in range(60):
        lang = list(kinds)[i % 3]
        texts.append(" ".join(rng.choice(kinds[lang].split()) + rng.choice("abst") for _ in range(6)))
        langs.append(lang)
    docs = documents(texts).drop("lang").join(
        spark.createDataFrame(list(enumerate(langs)), "doc_id bigint, lang string"), "doc_id")
    training = ~language.held_out()
    model = {r.name: np.array(r.vector) for r in language.fit(docs, training).collect()}
    want = {k: sum(brute_vector(t) for i, t in enumerate(texts)
                   if langs[i] == k and zlib.crc32(str(i).encode()) % 5) for k in kinds}
    assert all((model[k] == want[k]).all() for k in kinds)
    for r in language.predict(docs, language.fit(docs, training), ["doc_id"]).collect():
        v = brute_vector(texts[r.doc_id])
        cos = {k: v @ want[k] / np.linalg.norm(v) / np.linalg.norm(want[k]) for k in kinds}
        assert r.lang_pred == max(sorted(cos), key=cos.get)
        assert r.score == pytest.approx(max(cos.values()), abs=1e-5)


def test_nulls_empty_long_ties_and_clashing_columns(spark, documents):
    texts = [None, "", "123 ...", "word " * 300000, "word", "word", "Ω"]
    docs = documents(texts, ids=[0, 1, 2, 3, 4, 4, None]).withColumn("name", F.lit(1)).withColumn("score", F.lit("x"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") != 2, "aa"))
    twice = docs.unionByName(docs.withColumn("lang", F.when(F.col("lang").isNotNull(), "ab")))
    got = language.predict(docs, language.fit(twice, F.lit(True)), ["doc_id"]).collect()
    kind = Counter((r.doc_id, r.lang_pred) for r in got)
    assert kind == {(0, "und"): 1, (1, "und"): 1, (2, "und"): 1, (3, "aa"): 1, (4, "aa"): 2, (None, "aa"): 1}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert language.predict(docs.limit(0), language.fit(docs, F.lit(True)), ["doc_id"]).count() == 0
    none = language.fit(docs.limit(0), F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, none, ["doc_id"]).collect()} == {("und", 0.0)}


def test_the_split_of_rows_does_not_matter(spark, documents, rng):
    docs = documents([sentence(rng, 30) for _ in range(50)])
    a, b = (language.fit(docs.repartition(n), F.lit(True)).collect() for n in (1, 7))
    assert a == b


def test_many_language_names(spark, monkeypatch):
    docs = spark.range(300).select(F.concat(F.lit("l"), F.col("id")).alias("lang"), F.lit("some text").alias("text"))
    assert language.fit(docs.repartition(2), F.lit(True)).count() == 300
    monkeypatch.setattr(language, "MOST_LANGUAGES", 10)
    with pytest.raises(ValueError):
        language.predict(docs, language.fit(docs, F.lit(True)), ["lang"])
