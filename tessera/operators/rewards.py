"""Scores of completions as column expressions: form, length, repeated n-grams
and their weighted sum with accuracy.

A null completion counts as empty text, a null ``correct`` as wrong. Each
score is a function of its own row, linear in the text's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c, whitespace_tokens

# Defaults of the declared configuration (fixed values).
WEIGHTS = {"accuracy": 2.0, "format": 1.0}
MIN_WRONG, MAX_WRONG = 0.0, -0.5
MIN_CORRECT, MAX_CORRECT = 0.5, 1.0
MAX_LENGTH = 1000
N_GRAM = 3
MAX_PENALTY = -1.0

BETWEEN = r"</think>[ \t\n\r\f\x0B]*<answer>"


def _text(completion) -> Column:
    return F.coalesce(c(completion), F.lit(""))


def format_score(completion) -> Column:
    """1 for a text that is ``<think>...</think>``, white space, ``<answer>...</answer>`` from
    end to end, else 0. The tags can't overlap, so three tests in the text decide."""
    x = _text(completion)
    return (x.startswith("<think>") & x.endswith("</answer>") & x.rlike(BETWEEN)).cast("double")


def length_score(length, correct, max_length: int = MAX_LENGTH, wrong=(MIN_WRONG, MAX_WRONG),
                 right=(MIN_CORRECT, MAX_CORRECT)) -> Column:
    """Half a cosine over ``length / max_length`` (1 beyond it). Right answers fall from the upper to the lower
    value of ``right`` as they get longer; wrong ones go from the second value of ``wrong`` to the first."""
    if max_length < 1:
        raise ValueError("max_length must be positive")
    share = F.least(c(length) / F.lit(float(max_length)), F.lit(1.0))
    wave = (1 + F.cos(share * F.pi())) / 2
    correct = F.coalesce(c(correct), F.lit(False))

    def between(start, end):
        return F.lit(float(end)) + (start - end) * wave

    return F.when(correct, between(right[1], right[0])).otherwise(between(wrong[1], wrong[0]))


def repetition_score(completion, n: int = N_GRAM, max_penalty: float = MAX_PENALTY) -> Column:
    """``max_penalty`` times the share of n-grams (of lower-cased words) that repeat an earlier one;
    0 for texts of fewer than ``n`` words. N-grams are joined from shifted word arrays, place by place."""
    if n < 1:
        raise ValueError("n must be positive")
    words = whitespace_tokens(F.lower(_text(completion)))
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    grams = F.slice(words, F.lit(1), count)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(words, F.lit(k + 1), count), lambda a, b: F.concat(a, F.lit(" "), b))
    repeated = F.size(grams) - F.size(F.array_distinct(grams))
    return F.when(repeated > 0, max_penalty * repeated / F.size(grams)).otherwise(F.lit(0.0))


def with_rewards(df: DataFrame, completion: str = "completion", correct: str = "correct",
                 weights: dict[str, float] | None = None, n: int = N_GRAM, max_length: int = MAX_LENGTH) -> DataFrame:
    """Add ``<name>_score`` for each name of ``weights`` (``accuracy``, ``format``, ``length``, ``repetition``)
    and ``reward``, their weighted sum. Length is in words."""
    weights = WEIGHTS if weights is None else weights
    made = {"accuracy": lambda: F.coalesce(F.col(correct), F.lit(False)).cast("double"),
            "format": lambda: format_score(completion),
            "length": lambda: length_score(F.size(whitespace_tokens(_text(completion))), correct, max_length),
            "repetition": lambda: repetition_score(completion, n)}
    unknown = sorted(set(weights) - set(made))
    if unknown or not weights:
        raise ValueError(f"unknown scores {unknown}; known: {sorted(made)}")
    scored = df.withColumns({f"{name}_score": made[name]() for name in weights})
    total = sum((F.lit(float(w)) * F.col(f"{name}_score") for name, w in weights.items()), F.lit(0.0))
    return scored.withColumn("reward", total)
