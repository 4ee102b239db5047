"""Reference-shaped inputs derived from the driver tables by Spark.

Every derivation is a scan plus column expressions or equi-joins, so its
work grows with the tables. The same derivations are written in SQL in
``tessera.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problem/answer rows: a user turn followed by an assistant turn.

    Equi-join on ``(conv_id, turn)``: both keys together are unique, so a
    conversation holding a large share of all rows still spreads over many
    shuffle partitions (a window per conversation would not).
    """
    conv = read(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("problem"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"])


def trace_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in the shape of a trace source: question, trace, short attempt."""
    p = pairs(spark, sf_dir)
    return p.select("conv_id", "turn", F.col("problem").alias("question"),
                    F.col("answer").alias("thinking_trajectories"),
                    F.substring_index("answer", "\n", 1).alias("attempt"))


def layer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct module names ``model.layers.N`` derived from part keys."""
    part = read(spark, sf_dir, "part")
    return part.select(F.concat(F.lit("model.layers."), (F.col("p_partkey") % 28).cast("string"))
                       .alias("name")).distinct()


def module_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct module names with one or two numbers, and text after the first one."""
    part = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rest = (F.when(k % 3 == 0, F.lit(".self_attn")).when(k % 3 == 1, F.concat(F.lit(".mlp.experts."), (k % 11).cast("string")))
            .otherwise(F.lit("")))
    return part.select(F.concat(F.lit("model.layers."), (k % 12).cast("string"), rest).alias("name")).distinct()


def tool_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which some user turns are tool outputs, some assistant turns tool calls, and some texts null."""
    conv = read(spark, sf_dir, "conversations")
    t = F.col("turn")
    role = F.when((F.col("role") == "user") & (t % 4 >= 2), F.lit("tool")).otherwise(F.col("role"))
    call = (F.col("role") == "assistant") & (F.col("conv_id") % 3 == 0) & (t % 4 == 1)
    calls = F.when(call, F.array(*[F.struct(F.lit("function").alias("type"), F.lit(n).alias("name"), F.concat(
        F.lit('{"turn": '), t.cast("string"), F.lit("}")).alias("arguments")) for n in ("look", "read")]))
    text = F.when(call | ((F.col("conv_id") % 5 == 0) & (t % 4 == 0)), F.lit(None)).otherwise(F.col("text"))
    return conv.select("conv_id", "turn", role.alias("role"), text.alias("text"), calls.alias("calls"))


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark rows with every task's question and gold columns."""
    b = read(spark, sf_dir, "benchmark")
    gold = F.length("text").cast("string")
    return b.select("item_id", F.col("text").alias("problem"), F.col("text").alias("question"),
                    gold.alias("answer"), gold.alias("solution"))


def choice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question + correct + three wrong answers from the items of a window of
    five ids; where a later id is absent, the text of the question's item
    stands in with the place's number after it, so every item has a row.

    Each item contributes its text to the five windows it belongs to
    (``item_id - j`` for j = 0..4); one grouped pivot then assembles every
    window: a single shuffle instead of four self-joins.
    """
    b = read(spark, sf_dir, "benchmark").select("item_id", "text")
    names = ["Question", "Correct Answer", "Incorrect Answer 1", "Incorrect Answer 2", "Incorrect Answer 3"]
    parts = b.select(F.explode(F.array(*[
        F.struct((F.col("item_id") - j).alias("base"), F.lit(j).alias("j"), F.col("text").alias("text"))
        for j in range(len(names))])).alias("c")).select("c.*")
    g = parts.groupBy(F.col("base").alias("item_id")).agg(
        *[F.max(F.when(F.col("j") == j, F.col("text"))).alias(nm) for j, nm in enumerate(names)])
    return g.where(F.col("Question").isNotNull()).select("item_id", "Question", *[
        F.coalesce(F.col(nm), F.concat("Question", F.lit(f" ({j})"))).alias(nm) for j, nm in enumerate(names) if j])


# ---------------------------------------------------------------- vectors

# Embeddings with vec_id below this form the dictionary (the fixture's model
# parameters); every other embedding is a data vector, so queries over
# vectors cover the rest of the table in full.
DICT_ROWS = 64
K = 4


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.functions.columns import as_double_array
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", as_double_array("embedding").alias("vec"))


def data_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors to encode: every embedding outside the dictionary rows."""
    return embedding_vectors(spark, sf_dir).where(F.col("vec_id") >= DICT_ROWS)


def dictionary(spark: SparkSession, sf_dir: str, k: int = K, **kw):
    """Dictionary from the first embedding rows: encoder = the rows, decoder =
    their unit-normed copy, encoder bias 0, decoder bias = mean data vector."""
    from tessera.operators.sparse import SparseDictionary, mean_vector, normalize_rows
    rows = embedding_vectors(spark, sf_dir).where(F.col("vec_id") < DICT_ROWS)
    entries = normalize_rows(rows.select(F.col("vec_id").alias("latent_id"), F.col("vec").alias("w_enc"),
                                         F.lit(0.0).alias("b_enc"), F.col("vec").alias("w_dec")), "w_dec")
    # d doubles: the only value brought to the driver, as a model parameter
    b_dec = mean_vector(data_vectors(spark, sf_dir), "vec").first()["mean"]
    return SparseDictionary(entries=entries, b_dec=list(b_dec), k=k, **kw)


# ---------------------------------------------------------------- runs and answers

def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric log rows: name = event type, step = event id, value."""
    ev = read(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("name"), F.col("event_id").alias("step"), "value")


def predictions(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """Gold texts from line quantities and model outputs, a share of them
    wrong: boxed fractions, nested braces, grouped digits, plain numbers,
    whole solutions as gold.

    The task (all tasks of the evaluation occur) follows from the line's key,
    the checkpoint from its number.
    """
    from tessera.functions.columns import seeded_hash
    from tessera.operators.evaluate import TASK_KINDS, task_kind
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    names = F.array(*[F.lit(t) for t in TASK_KINDS])
    li = li.withColumn("h", F.pmod(seeded_hash(seed, "l_orderkey", "l_linenumber"), F.lit(10))).withColumn(
        "task", names[(F.col("l_orderkey") % len(TASK_KINDS)).cast("int")]).withColumn("kind", task_kind("task")).withColumn(
        "q", F.col("l_quantity").cast("bigint")).withColumn("said", F.col("q") + F.when(F.col("h") < 3, 1).otherwise(0))
    q, said, h = F.col("q").cast("string"), F.col("said").cast("string"), F.col("h")
    letter = lambda shift: F.substr(F.lit("ABCD"), ((F.col("l_linenumber") + shift) % 4 + 1).cast("int"), F.lit(1))
    gold = (F.when(F.col("kind") == "letter", letter(0))
            .when((F.col("kind") == "latex") & (h % 3 == 0), F.concat(F.lit("Half of it: 12 and 7, so $x=\\boxed{\\frac{"), q, F.lit("}{2}}$ holds.")))
            .when((F.col("kind") == "latex") & (h == 7), F.concat(F.lit("We get \\boxed{x^" + "{" * 20), q, F.lit("}" * 20 + "}.")))
            .when((F.col("kind") == "latex") & (h % 3 == 1), F.concat(F.lit("We get \\boxed{x^{"), q, F.lit("}}.")))
            .when(F.col("kind") == "latex", F.concat(F.lit("In all $"), q, F.lit(",500$ of them")))
            .when(h % 2 == 0, q).otherwise(F.concat(q, F.lit(",250"))))
    pred = (F.when(F.col("kind") == "letter", F.concat(F.lit("Answer: "), F.when(h < 2, letter(1)).otherwise(letter(0))))
            .when((F.col("kind") == "latex") & (h % 3 == 0) & (h > 5), F.concat(F.lit("it is "), said, F.lit("/2")))
            .when((F.col("kind") == "latex") & (h % 3 == 0), F.concat(F.lit("the answer is: $\\boxed{ \\dfrac{"), said, F.lit("}{2} }$. I hope it is correct")))
            .when((F.col("kind") == "latex") & (h == 7), F.concat(F.lit("\\boxed{\\text{x}^" + "{" * 20), said, F.lit("}" * 20 + "} or 3")))
            .when((F.col("kind") == "latex") & (h % 3 == 1), F.concat(F.lit("\\boxed{\\text{x}^{"), said, F.lit("}} or 3")))
            .when(F.col("kind") == "latex", F.concat(F.lit("so \\boxed{"), said, F.lit("500.0}")))
            .when(h == 4, F.concat(F.lit("somewhere between 1-"), said))
            .when(h == 6, F.concat(F.lit("it is "), said, F.lit("00e-2 in all")))
            .when(h == 8, F.concat(F.lit("so x = +"), said, F.lit(".")))
            .when(h % 2 == 0, F.concat(F.lit("The 1st result: "), said, F.lit(" units")))
            .otherwise(F.concat(F.lit("I think "), said, F.lit("250 not 5f, no: \\boxed{"), said, F.lit(",250}"))))
    return li.select("l_orderkey", "l_linenumber", "task", "kind",
                     F.concat(F.lit("checkpoint-"), (F.col("l_linenumber") * 100).cast("string")).alias("checkpoint"),
                     gold.alias("gold_text"), pred.alias("prediction"))


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant texts as thoughts and user texts as answers in tags, some without a tag or with a text around
    them, some null; whether the answer counts as right."""
    p = pairs(spark, sf_dir)
    way = (F.col("conv_id") + F.col("turn")) % 7
    whole = F.concat(F.lit("<think>"), "answer", F.lit("</think>\n<answer>"), "problem", F.lit("</answer>"))
    text = (F.when(way == 1, F.col("answer")).when(way == 2, F.concat(whole, F.lit(" so"))).when(way == 3, F.lit(None))
            .when(way == 4, F.concat(F.lit("<think>"), "answer", F.lit(" "), "answer", F.lit("</think><answer>x</answer>")))
            .when(way == 5, F.concat(F.lit("<think>"), "answer", F.lit("</answer>"))).otherwise(whole))
    return p.select("conv_id", "turn", text.alias("completion"), (F.col("conv_id") % 2 == 0).alias("correct"))
