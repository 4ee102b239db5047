import fnmatch

import pytest
from pyspark.sql import functions as F

from tessera.functions.columns import glob_to_regex
from tessera.operators import schema as sc

NAMES = ["embed_tokens", "layers.1.mlp", "layers.2", "layers.10", "layers.10.mlp", "layers.[1]", "a/b.c"]


@pytest.mark.parametrize("pat", ["layers.1*", "layers.?", "layers.[12]*", "layers.[!1]*", "*mlp", "a/*", "layers.[[]1]"])
def test_glob_matches_fnmatchcase(spark, pat):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = sorted(r["name"] for r in sc.filter_glob(df, "name", [pat]).collect())
    assert got == sorted(n for n in NAMES if fnmatch.fnmatchcase(n, pat)), glob_to_regex(pat)


def test_natural_order(spark):
    df = spark.createDataFrame([(n,) for n in ["layers.10", "embed_tokens", "layers.2", "layers.1.mlp"]], "name string")
    assert [r["name"] for r in sc.order_natural(df, "name").collect()] == \
        ["embed_tokens", "layers.1.mlp", "layers.2", "layers.10"]


def test_json_answer_null_and_missing(spark):
    df = spark.createDataFrame([('{"answer": {"value": 3}}',), ('{"answer": {}}',), (None,)], "j string")
    assert [r["a"] for r in df.select(sc.json_answer("j").alias("a")).collect()] == ["$3$", None, None]


def test_resolve_problem_and_errors(spark):
    df = spark.createDataFrame([("p?",)], "prompt string")
    assert sc.resolve_problem(df).first()["problem"] == "p?"
    with pytest.raises(ValueError):
        sc.resolve_problem(spark.createDataFrame([("x",)], "other string"))
    with pytest.raises(ValueError):
        sc.resolve_trace(df, "unknown/source")
    with pytest.raises(ValueError):
        sc.union_splits(df, spark.createDataFrame([("x",)], "other string"))


def test_first_field_of_empty_array_is_null(spark):
    df = spark.createDataFrame([([],)], "m array<struct<content:string>>")
    assert df.select(sc.first_field("m", "content").alias("c")).first()["c"] is None


def test_stride_with_explicit_layers_is_rejected(spark):
    df = spark.createDataFrame([("layers.1",)], "name string")
    with pytest.raises(ValueError):
        sc.select_hookpoints(df, layers=[1], stride=2)


def test_first_message_long_form_equals_array_form(spark):
    rows = [(1, 5, "assistant", "b"), (1, 2, "user", "a"), (2, 7, "system", "s"), (2, 9, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    long_form = {r["conv_id"]: (r["role"], r["text"], r["n_messages"]) for r in sc.first_message(df).collect()}
    arrays = df.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", "role", F.col("text").alias("content")))).alias("messages"))
    info = F.concat(F.lit('{"answer": {"value": '), F.size("messages").cast("string"), F.lit("}}"))
    adapted = sc.adapt_messages(arrays.select("conv_id", "messages", info.alias("verification_info")))
    arr = {r["conv_id"]: (r["problem"], r["answer"]) for r in adapted.collect()}
    assert long_form == {1: ("user", "a", 2), 2: ("system", "s", 2)}
    assert arr == {1: ("a", "$2$"), 2: ("s", "$2$")}


def test_natural_order_compares_text_and_numbers_in_turn(spark):
    from tessera.functions.columns import natural_sort_keys
    names = ["layers.0.self_attn", "layers.0.mlp.experts.10", "layers.0.mlp.experts.3", "layers.10", "layers.2", "layers", "2", "10", "a2b",
             "a02b", "a2", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r["name"] for r in df.orderBy(*natural_sort_keys("name")).collect()]
    assert got == ["", "2", "10", "a2", "a02b", "a2b", "layers", "layers.0.mlp.experts.3", "layers.0.mlp.experts.10", "layers.0.self_attn",
                   "layers.2", "layers.10"]
