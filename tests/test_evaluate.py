"""Answer extraction and scoring on answers that are more than one number."""

import pytest

from tessera.operators import evaluate as ev


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column("t").alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [
    (r"so \boxed{\frac{1}{2}} or 2", r"\frac{1}{2}"),
    (r"\boxed{a{b{c{d}e}f}g} then \boxed{2}", "a{b{c{d}e}f}g"),
    (r"\boxed{1,234}", "1,234"), ("about 1,234 in all", "1,234"), ("it is 3/4.", "3/4"), (r"so \frac{3}{4}", r"\frac{3}{4}"),
    ("no number", None), (r"\boxed{}", ""), ("-5.50 and", "-5.50"), (r"\boxed{unclosed 7", "7"),
    ("the answer is .5", ".5"), ("it is 2.5e-3", "2.5e-3"), ("between 2009-2012", "2012"), ("so +3", "+3"), ("x = -3.", "-3"),
    ("1,2345 in", "2345"), ("1,234,56", "56"), (r"-\frac{1}{2}", r"-\frac{1}{2}"), ("1E5", "1E5"), ("a 3/4-5/8", "5/8"),
    (r"\boxed{open \boxed {2} or \boxed{3}", "2"), (r"\boxed {a}\boxed{b}", "a"), (r"x} \boxed{{y}} }", "{y}"),
    (r"\boxed{" + "{" * 20 + "8" + "}" * 20 + "} or 4", "{" * 20 + "8" + "}" * 20), (r"\boxed 5 {6}", "6"), (None, None), ("", None)])
def test_predictions(spark, text, want):
    for kind in ("latex", "expr"):
        assert one(spark, text, lambda t: ev.extract_answer(t, kind)) == want


@pytest.mark.parametrize("kind, text, want", [
    ("latex", r"We see 3. Thus $x=\boxed{\frac{7}{2}}$ as $y$.", r"\frac{7}{2}"), ("latex", "So $12$ or $13$ are left", "13"),
    ("latex", "So 15 in all", "15"), ("latex", "none", "none"), ("expr", r"\boxed{3} or 4", "4"), ("expr", "even", "even"),
    ("letter", "Answer: C", "C"), ("letter", "B", "B")])
def test_gold_texts(spark, kind, text, want):
    assert one(spark, text, lambda t: ev.extract_gold(t, kind)) == want


@pytest.mark.parametrize("pred, gold, equal", [
    (r"\frac{1}{2}", "0.5", 1), (r"\dfrac{1}{2}", r"\frac{1}{2}", 1), ("1/2", r"\frac12", 0), ("1,234", "1234", 1), ("1,23", "123", 0),
    ("5f", "5", 0), ("5.", "5", 1), ("NaN", "NaN", 1), ("1e3", "1000", 1), (".5", "1/2", 1), ("2.5e-3", "0.0025", 1), ("+3", "3", 1), ("1e999", "2", 0), ("e3", "1000", 0), ("0.333333", "1/3", 1), ("1/0", "1/0", 1), ("2", r"\frac{1}{2}", 0),
    (r"\text{cm}", "cm", 1), ("$ 5 $", "5", 1), (r"-\frac{1}{2}", "-0.5", 1), (None, "5", 0), ("5", None, 0), ("", "", 1)])
def test_equality(spark, pred, gold, equal):
    df = spark.createDataFrame([(pred, gold)], "pred string, gold string")
    assert ev.with_score(df).first()["score"] == equal


def test_score_is_the_best_of_all_pairs(spark):
    df = spark.createDataFrame([(["1", "2"], ["3", "2.0"]), (["1"], ["3"]), ([], ["3"]), (None, ["3"])], "pred array<string>, gold array<string>")
    assert [r["score"] for r in ev.with_score(df).collect()] == [1, 0, 0, 0]


def test_tasks_have_the_metric_of_their_kind(spark):
    df = spark.createDataFrame([("aime24",), ("math_500",), ("gpqa:diamond",), ("other",)], "task string")
    assert [r["k"] for r in df.select(ev.task_kind("task").alias("k")).collect()] == ["expr", "latex", "letter", None]
    x = spark.createDataFrame([("letter", "Answer: B"), ("expr", "so 4"), ("latex", r"\boxed{x}"), ("other", "5")], "kind string, p string")
    assert [r["a"] for r in x.select(ev.by_kind("kind", ev.extract_answer, "p").alias("a")).collect()] == ["B", "4", "x", None]


def test_long_braces_do_not_overflow(spark):
    text = r"\boxed{" + "x" * 200_000 + "{" + "y" * 100_000 + "}" * 2 + " 3"
    assert len(one(spark, text, lambda t: ev.extract_answer(t))) == 300_002
    deep = r"\boxed{" + "{" * 5000 + "}" * 5000 + "} or 4"
    assert one(spark, deep, lambda t: ev.extract_answer(t)) == "{" * 5000 + "}" * 5000
    assert one(spark, deep.replace("} or", " or"), lambda t: ev.extract_answer(t)) == "4"
