import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import agrees
from pyspark.sql import functions as F

from tessera.llm import phrases


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, top, cover):
    out = []
    for lang in {x for x, _ in rows}:
        ps = [p for x, t in rows if x == lang for p in pieces(t)]
        f = [Counter(tuple(p[i:i + n]) for p in ps for i in range(len(p) - n + 1)) for n in (1, 2, 3)]
        n = sum(f[0].values())
        cand = {p: c for g in f[1:] for p, c in g.items() if c >= least}
        mine = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * c >= cover * a for q, c in f[2].items()
                                   if c >= least and (q[:2] == p or q[1:] == p)):
                continue
            s, k = min((1000000 * a * a // (f[k - 1][p[:k]] * f[len(p) - k - 1][p[k:]]), k) for k in range(1, len(p)))
            mine.append((s, a, " ".join(p), f[k - 1][p[:k]], f[len(p) - k - 1][p[k:]]))
        mine.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, lf, r, n, s) for i, (s, a, p, lf, r) in enumerate(mine[:top])]
    return sorted(out)


def test_words_and_pieces(rng):
    texts = [None, "", "a", "A b", " a\tb,c .d\n\ne", "é É\x0b\x1cx\x85y z", "tail ", "next"]
    texts += ["".join(rng.choice("ab .,\n\té") for _ in range(rng.randrange(40))) for _ in range(300)]
    for cut in (0, 1, 3):
        part = pa.array([""] * cut + texts, pa.string()).slice(cut)
        words, text, goes_on = phrases.scanned(part)
        want = [(w, i, k > 0) for i, t in enumerate(texts) for p in pieces(t) for k, w in enumerate(p)]
        assert list(zip(words.to_pylist(), text.tolist(), goes_on.tolist(), strict=True)) == want


def test_tiles_count_all_pairs():
    rng = np.random.default_rng(3)
    for ids in (np.arange(600), rng.permutation(600), rng.permutation(5000)[:600] * 10_000_000):
        for tile in (2, 16, 64):
            for n in (0, 1, 4000):
                left, right = rng.zipf(1.3, n) % 600, rng.zipf(1.3, n) % 600
                a, b, c, at = phrases.tiled(left, right, ids, ids, tile)
                assert dict(zip(zip(a, b, strict=True), c, strict=True)) == Counter(zip(left, right, strict=True))
                assert (a[at] == left).all() and (b[at] == right).all()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("tile", [2, 256])
def test_equals_brute_force(spark, rng, monkeypatch, tile):
    monkeypatch.setattr(phrases, "BLOCK", 2000)
    words = "the of New york a b é über to and in is".split()
    rows = []
    for i in range(300):
        t = "".join(rng.choice(words[:1 + int(rng.random() ** 2 * 12)]) + rng.choice(["", " ", " ", " ", " ", ", ", ".\n"])
                    for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "de", None, "und"]), rng.choice([t, t, t, None, ""])))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    df = df.withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("block", F.lit(None))
    known = [(x or "und", t) for x, t in rows]
    for least, top, cover in ((3, 50, 50), (10, 5, 90)):
        assert rows_of(phrases.mine(df, least, top, cover, tile)) == brute(known, least, top, cover)


def test_long_texts_repeats_and_empty_tables(spark):
    long = "one two three. " * 60000
    df = spark.createDataFrame([("en", long), ("en", long), ("fr", "x y"), (None, None)], "lang string, text string")
    assert [(r.phrase, r.a, r.n, r.score) for r in phrases.mine(df).collect()] == [
        ("one two three", 120000, 360000, 1000000)]
    assert phrases.mine(df.limit(0)).collect() == []
    assert phrases.mine(df.where("lang = 'fr'")).collect() == []


def test_scores_are_exact(spark):
    cases = [(10 ** 14 + 7, 10 ** 14 + 9, 3 * 10 ** 14 + 1), (123456789012345, 123456789012346, 999999999999999),
             (10, 10, 10), (3333333, 10 ** 15 - 1, 3333334)]
    df = spark.createDataFrame(cases, "a long, l long, r long").select("a", "l", "r", phrases.score("a", "l", "r").alias("s"))
    for r in df.collect():
        assert r.s == 1000000 * r.a * r.a // (r.l * r.r)


def test_oracle_agrees_on_the_smallest_tables(spark):
    agrees(spark, "op12_phrases")
