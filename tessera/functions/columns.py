"""Column-expression helpers shared by the operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none calls Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- hashing

def seeded_hash(seed: int, *keys) -> Column:
    """Deterministic 32-bit hash of ``seed:key1:key2...`` as a non-negative bigint.

    First 8 hex digits of an md5, so that SQL engines without Spark's
    murmur/xxhash can compute the same value. Independent of partitioning,
    unlike ``rand(seed)``.
    """
    parts = [F.lit(str(seed))] + [c(k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


# ---------------------------------------------------------------- text

def whitespace_tokens(text) -> Column:
    """Default tokenizer: maximal runs of non-whitespace.

    Written as a split on whitespace runs minus the empty edge pieces, which
    yields the same tokens as extracting ``\\S+`` and measured about 20%
    faster.
    """
    return F.array_remove(F.split(c(text), r"\s+"), "")


def glob_to_regex(pattern: str) -> str:
    """Translate a case-sensitive shell glob (``* ? [...]``) to an anchored regex.

    ``*`` and ``?`` match any character including ``.`` and ``/``, as in
    ``fnmatch.fnmatchcase``; ``[!...]`` negates a class.
    """
    out, i, n = [], 0, len(pattern)
    while i < n:
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append("(?s:.*)")
        elif ch == "?":
            out.append("(?s:.)")
        elif ch == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append(r"\[")
            else:
                body = pattern[i:j]
                i = j + 1
                neg = body.startswith("!")
                if neg:
                    body = body[1:]
                # Java reads '[', '&&' and '\\' inside a class specially: escape
                # every non-alphanumeric member except range dashes
                esc = "".join(ch if ch.isalnum() or ch == "-" else "\\" + ch for ch in body)
                out.append(f"[{'^' if neg else ''}{esc}]")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def matches_any_glob(col, patterns) -> Column:
    """True when ``col`` matches at least one glob pattern."""
    if isinstance(patterns, str):
        patterns = [patterns]
    cond = F.lit(False)
    for p in patterns:
        cond = cond | c(col).rlike(glob_to_regex(p))
    return cond


def natural_sort_keys(col) -> list[Column]:
    """Sort keys in which text and number pieces of a name are compared in
    turn (``layers.2`` < ``layers.10``, ``layers.0.mlp.3`` < ``layers.0.self``).

    Key 1: an array of (text, the number after it) pairs; key 2: the name
    itself, for names that differ in leading zeros only.
    """
    name = c(col)
    numbers = F.regexp_extract_all(name, F.lit(r"([0-9]+)"), 1)
    pairs = F.transform(F.split(name, "[0-9]+", -1), lambda text, i: F.struct(
        text.alias("text"), F.get(numbers, i).cast("decimal(38,0)").alias("number")))
    return [pairs, name]


# ---------------------------------------------------------------- vectors

def as_double_array(col) -> Column:
    return F.transform(c(col), lambda v: v.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(c(a), c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_norm(a) -> Column:
    return F.aggregate(c(a), F.lit(0.0), lambda acc, v: acc + v * v)


def l2_norm(a) -> Column:
    return F.sqrt(sq_norm(a))


def vsub(a, b) -> Column:
    return F.zip_with(c(a), c(b), lambda x, y: x - y)


def _per_element(a, s) -> Column:
    """Repeat a per-row scalar to the array's length.

    A row scalar written inside a lambda is re-evaluated for every element
    (Spark does not hoist it), so an O(d) scalar such as a norm would make
    the lambda O(d^2); passing it as an array argument evaluates it once.
    """
    s = F.lit(float(s)) if isinstance(s, (int, float)) else c(s)
    return F.array_repeat(s, F.size(c(a)))


def vscale(a, s) -> Column:
    """Multiply every element by a per-row scalar (evaluated once per row)."""
    return F.zip_with(c(a), _per_element(a, s), lambda x, y: x * y)


def vshift(a, s) -> Column:
    """Subtract a per-row scalar from every element (evaluated once per row)."""
    return F.zip_with(c(a), _per_element(a, s), lambda x, y: x - y)


def fixed6(x) -> Column:
    """A number rounded to 6 decimals as text (``-0`` prints as ``0.000000``)."""
    return F.round(c(x), 6).cast("decimal(18,6)").cast("string")


def array_md5(a) -> Column:
    """Stable fingerprint of a numeric array after rounding to 6 decimals."""
    return F.md5(F.array_join(F.transform(c(a), fixed6), ","))
