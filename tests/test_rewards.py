"""Scores of completions against direct computation."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import rewards as rw

TEXTS = [None, "", "a", "A b a B a b", "x " * 500, "<think></think><answer></answer>", "<think>a</think> \n<answer>b</answer>",
         "<think>a</think>b<answer>c</answer>", "<think>a<answer>b</answer>", " <think>a</think><answer>b</answer>",
         "<think>a</think><answer>b</answer>\n", "<think>\n</think>\t<answer>1\n2</answer>", "é É é É é"]


def repeated(text, n):
    w = (text or "").lower().split()
    grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
    return -(1 - len(set(grams)) / len(grams)) if grams else 0.0


def test_scores_of_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = df.select("i", rw.format_score("t").alias("f"), *[rw.repetition_score("t", n).alias(f"r{n}") for n in (1, 2, 3)]).collect()
    for r in got:
        assert r["f"] == (1.0 if r["i"] in (5, 6, 11) else 0.0), r
        for n in (1, 2, 3):
            assert r[f"r{n}"] == pytest.approx(repeated(TEXTS[r["i"]], n))


def test_length_score_runs_between_its_ends(spark):
    rows = [(n, ok) for n in (0, 250, 500, 1000, 5000) for ok in (True, False, None)]
    df = spark.createDataFrame(rows, "n int, ok boolean")
    for r in df.select("*", rw.length_score("n", "ok").alias("s")).collect():
        wave = (1 + math.cos(math.pi * min(r["n"] / 1000, 1))) / 2
        low, high = (0.5, 1.0) if r["ok"] else (0.0, -0.5)
        assert r["s"] == pytest.approx(low + (high - low) * wave)


def test_weighted_sum_and_unknown_names(spark):
    df = spark.createDataFrame([("<think>a</think><answer>b</answer>", True), (None, None)], "completion string, correct boolean")
    assert [r["reward"] for r in rw.with_rewards(df).orderBy(F.desc("reward")).collect()] == [3.0, 0.0]
    both = rw.with_rewards(df, weights={"repetition": 1.0, "length": 0.5}).orderBy("completion").collect()
    assert both[0]["reward"] == pytest.approx(0.5 * -0.5) and both[1]["repetition_score"] == 0.0
    with pytest.raises(ValueError, match="unknown"):
        rw.with_rewards(df, weights={"tone": 1.0})
    assert rw.with_rewards(df.limit(0)).count() == 0
