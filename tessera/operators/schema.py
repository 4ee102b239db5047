"""Projections, filters and schema reconciliation.

Schema decisions (which column exists) are taken on the driver from the
DataFrame's schema; everything per row is a built-in column expression, so
filters stay pushable into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c, matches_any_glob, natural_sort_keys

# Per-source (trace column, answer column) bindings.
SFT_TRACE_COLUMNS = {
    "simplescaling/s1K-claude-3-7-sonnet": ("claude_thinking_trajectory", "claude_attempt"),
    "simplescaling/s1K-1.1": ("deepseek_thinking_trajectory", "deepseek_attempt"),
    "simplescaling/s1K": ("thinking_trajectories", "attempt"),
    "GAIR/LIMO": ("solution", "answer"),
    "RUC-AIBOX/STILL-3-Preview-RL-Data": ("answer", "answer"),
    "agentica-org/DeepScaleR-Preview-Dataset": ("solution", "answer"),
}

# Sources accepted by the dictionary-tuning path (subset of the above).
SAE_TRACE_SOURCES = ("simplescaling/s1K-claude-3-7-sonnet", "simplescaling/s1K-1.1", "simplescaling/s1K")

PROBLEM_CANDIDATES = ("problem", "question", "prompt")


def rename_if_missing(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Rename ``src`` to ``dst`` only when ``dst`` is absent (B1)."""
    if dst in df.columns or src not in df.columns:
        return df
    return df.withColumnRenamed(src, dst)


def resolve_problem(df: DataFrame) -> DataFrame:
    """Provide ``problem`` from the first present of problem/question/prompt (B2).

    Presence is a schema test, not a null test: a present-but-null
    ``problem`` stays null.
    """
    for name in PROBLEM_CANDIDATES:
        if name in df.columns:
            return df if name == "problem" else df.withColumn("problem", F.col(name))
    raise ValueError("the table has none of the columns problem, question, prompt")


def resolve_trace(df: DataFrame, source: str, sae: bool = False) -> DataFrame:
    """Project the per-source reasoning trace and answer as ``trace``/``answer``."""
    allowed = SAE_TRACE_SOURCES if sae else tuple(SFT_TRACE_COLUMNS)
    if source not in allowed:
        raise ValueError(f"no trace columns are known for source {source!r}")
    trace, answer = SFT_TRACE_COLUMNS[source]
    keep = [x for x in df.columns if x not in ("trace", "answer", trace, answer)]
    return df.select(*keep, F.col(trace).alias("trace"), F.col(answer).alias("answer"))


def union_splits(*dfs: DataFrame, require=()) -> DataFrame:
    """Union splits that must share one column set."""
    if not dfs:
        raise ValueError("no splits given")
    cols = dfs[0].columns
    for d in dfs[1:]:
        if d.columns != cols:
            raise ValueError("splits differ in their columns")
    for r in require:
        if r not in cols:
            raise ValueError(f"Column {r!r} not found")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def first_field(col, field: str, strict: bool = False) -> Column:
    """Field of the first array element (B9); null for an empty array unless strict."""
    if strict:
        return F.element_at(c(col), 1)[field]
    return F.try_element_at(c(col), F.lit(1))[field]


def json_answer(col, path: str = "$.answer.value", strict: bool = False) -> Column:
    """JSON value at ``path`` wrapped as ``$value$`` (B10); missing key gives null."""
    v = F.get_json_object(c(col), path)
    out = F.concat(F.lit("$"), v, F.lit("$"))
    if strict:
        out = F.when(v.isNotNull(), out).otherwise(F.raise_error(F.lit(f"missing JSON path {path}")))
    return out


def adapt_messages(df: DataFrame, messages: str = "messages", info: str = "verification_info") -> DataFrame:
    """Message/JSON source adapter in one projection (B5): problem = first
    message content, answer = ``$answer.value$`` from the JSON column."""
    keep = [x for x in df.columns if x not in (messages, info, "problem", "answer")]
    return df.select(*keep, first_field(messages, "content").alias("problem"),
                     json_answer(info).alias("answer"))


def filter_domain(df: DataFrame, value: str, col: str = "domain") -> DataFrame:
    """Equality predicate (B7); a plain comparison, so it reaches the scan."""
    return df.where(F.col(col) == F.lit(value))


def filter_glob(df: DataFrame, col: str, patterns) -> DataFrame:
    """Keep rows whose name matches any case-sensitive glob."""
    return df.where(matches_any_glob(col, patterns))


def order_natural(df: DataFrame, col: str) -> DataFrame:
    """Natural sort of names."""
    return df.orderBy(*natural_sort_keys(col))


def natural_rank(df: DataFrame, col: str, name: str = "rank") -> DataFrame:
    """1-based natural-order rank over a name list (hookpoint lists are
    small: one row per module of a model)."""
    from tessera.operators.positions import with_index
    return with_index(df, natural_sort_keys(col), name).withColumn(name, F.col(name) + 1)


def stride(df: DataFrame, n: int, col: str, rank: str = "rank") -> DataFrame:
    """Every n-th name in natural order, starting with the first."""
    return natural_rank(df, col, rank).where((F.col(rank) - 1) % n == 0)


def rename_layer(col) -> Column:
    """``model.layers.N`` -> ``layers.N.mlp``."""
    return F.regexp_replace(c(col), r"model\.layers\.(\d+)", "layers.$1.mlp")


def hookpoint_of(col) -> Column:
    """Part of a name before the first ``/``."""
    return F.substring_index(c(col), "/", 1)


def layer_index(col) -> Column:
    """Layer number of a dotted name such as ``layers.12.mlp``."""
    return F.regexp_extract(c(col), r"layers\.(\d+)", 1).try_cast("bigint")


def select_hookpoints(df: DataFrame, col: str = "name", patterns=None, layers=None, stride: int = 1,
                      rank: str = "rank") -> DataFrame:
    """Module selection (B8 + B11-B13): glob patterns, or an explicit layer
    list, or every ``stride``-th name in natural order; a stride cannot be
    combined with explicit layers."""
    if layers and stride != 1:
        raise ValueError("give either layers or layer_stride, not both")
    x = df
    if patterns:
        x = filter_glob(x, col, patterns)
    if layers:
        x = x.where(F.regexp_extract(c(col), r"layers\.(\d+)", 1).try_cast("bigint").isin([int(v) for v in layers]))
    r = natural_rank(x, col, rank)
    return r.where((F.col(rank) - 1) % stride == 0) if stride != 1 else r


def first_message(df: DataFrame, key: str = "conv_id", order: str = "turn",
                  fields=("role", "text")) -> DataFrame:
    """Long-form B9: the fields of each conversation's first message.

    ``min_by`` over the turn is a partial aggregate (one candidate per key
    per task travels), so a conversation is never collected; it equals
    element 0 of the turn-ordered message array.
    """
    first = F.min_by(F.struct(*[F.col(f) for f in fields]), F.col(order))
    agg = df.groupBy(key).agg(first.alias("_f"), F.count(F.lit(1)).alias("n_messages"))
    return agg.select(key, *[F.col("_f")[f].alias(f) for f in fields], "n_messages")
