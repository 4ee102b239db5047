"""Answer extraction, scoring and accuracy (H1-H4).

The upstream evaluation harness compares answers symbolically; this is a
bounded subset expressed with built-in string functions.

* Predictions: the content of the first ``\\boxed{...}`` whose braces balance
  (nested to any depth), else the last number or fraction.
* Gold of the ``latex`` kind may be a whole solution: the first boxed
  content, else the last ``$...$``, else the last number or fraction, else
  the text. Gold of the ``expr`` kind: the last number or fraction, else the
  text.
* Numbers: plain, with a leading point, grouped digits or an exponent,
  fractions of whole numbers and ``\\frac``. A sign belongs to a number unless
  it follows a digit: the end of ``2009-2012`` is 2012.
* Letters: after ``Answer:``, else the last letter A to D that stands alone.

Two answers are equal when both are such numbers that agree at a number of
decimals, or when their normalised texts are. An item's score is the largest
over its gold and predicted answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c

# Extraction patterns.
BOXED = r"\\boxed\s*\{"
MATH = r"\$([^$]+)\$"
NUMBER = (r"((?:(?<![0-9])[-+])?(?:\\d?frac\{-?[0-9]+\}\{[0-9]+\}|[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?(?!,?[0-9])"
          r"|(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?(?:/[0-9]+)?))")
LETTER = r"Answer:\s*\$?\(?([A-D])\b"
BARE_LETTER = r"\b([A-D])\b"

# The tasks the evaluation script runs, and the kind of gold that each task's metric reads.
RUN_TASKS = ("aime24", "aime25", "amc23", "math_500", "minerva", "gpqa:diamond")
TASK_KINDS = {"aime24": "expr", "aime25": "expr", "amc23": "expr", "math_500": "latex", "minerva": "latex",
              "olympiadbench": "latex", "gpqa:diamond": "letter"}
KINDS = ("latex", "expr", "letter")


def task_kind(task) -> Column:
    """The kind of a task's metric (null for an unknown task)."""
    return F.create_map(*[F.lit(x) for pair in TASK_KINDS.items() for x in pair])[c(task)]


def _last(text, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), 1), F.lit(-1))


def _first(text, pattern: str) -> Column:
    """First match, null if none (an empty one is a match)."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def _with(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _balanced(tail: Column) -> Column:
    """The text up to the brace that closes the one before ``tail``; null if
    none does. Parts of the text end at a brace each; a running depth over
    them finds the part that brings it to 0."""
    def step(at, part):
        depth = at["depth"] + F.when(part.endswith("{"), 1).otherwise(-1)
        return F.when(at["depth"] == 0, at).otherwise(
            F.struct(depth.alias("depth"), (at["size"] + F.length(part)).alias("size")))

    end = F.aggregate(F.regexp_extract_all(tail, F.lit(r"[^{}]*[{}]"), 0),
                      F.struct(F.lit(1).alias("depth"), F.lit(0).alias("size")), step)
    nested = _with(end, lambda e: F.when(e["depth"] == 0, F.substring(tail, F.lit(1), e["size"] - 1)))
    plain = F.regexp_extract(tail, r"^([^{}]*)\}", 0)  # no braces inside
    return _with(plain, lambda p: F.when(p != "", F.substring(p, F.lit(1), F.length(p) - 1)).otherwise(nested))


def boxed(text: Column) -> Column:
    """The content of the first ``\\boxed{...}`` that is closed, else null. A
    later one is looked at only if the ones before it stay open."""
    tail = lambda x: F.regexp_extract(x, r"(?s)" + BOXED + "(.*)", 1)

    def later(x):
        at = F.split(x, r"(?=\\boxed\s*\{)")
        rest = lambda at: F.transform(F.sequence(F.lit(1), F.size(at)), lambda i: _with(
            tail(F.array_join(F.slice(at, i, F.size(at)), "")), _balanced))
        return F.get(F.filter(_with(at, rest), lambda y: y.isNotNull()), F.lit(0))

    return F.when(text.contains("\\boxed"), _with(text, lambda x: F.coalesce(_with(tail(x), _balanced), F.when(
        F.regexp_count(x, F.lit(BOXED)) > 1, later(x)))))


def extract_answer(col, kind: str = "latex") -> Column:
    """The answer of a prediction (H1). Both math kinds read predictions alike."""
    text = c(col)
    if kind in ("latex", "expr"):
        return F.trim(F.coalesce(boxed(text), _last(text, NUMBER)))
    if kind == "letter":
        return F.coalesce(_first(text, LETTER), _last(text, BARE_LETTER))
    raise ValueError(f"unknown answer kind {kind}")


def extract_gold(col, kind: str = "latex") -> Column:
    """The answer of a gold text (H1)."""
    text = c(col)
    if kind == "latex":
        return F.trim(F.coalesce(boxed(text), _last(text, MATH), _last(text, NUMBER), text))
    if kind == "expr":
        return F.trim(F.coalesce(_last(text, NUMBER), text))
    if kind == "letter":
        return F.coalesce(_first(text, LETTER), _last(text, BARE_LETTER))
    raise ValueError(f"unknown answer kind {kind}")


def by_kind(kind, extract, col) -> Column:
    """``extract`` of the kind that a row's column names."""
    if extract is extract_answer:  # both math kinds read predictions alike
        return F.when(c(kind).isin("latex", "expr"), extract(col, "latex")).when(c(kind) == "letter", extract(col, "letter"))
    return F.coalesce(*[F.when(c(kind) == k, extract(col, k)) for k in KINDS])


def normalised(col) -> Column:
    """An answer without markup that doesn't change it."""
    def stripped(x):
        x = F.regexp_replace(x, r"\\(?:left|right|!|,|;|\s)|\$|\s+", "")
        x = F.regexp_replace(x, r"\\[dt]frac", r"\\frac")
        x = F.regexp_replace(x, r"\\(?:text|mathrm|mbox)\{([^{}]*)\}", "$1")
        return F.regexp_replace(x, r"\\%|%$|\.$", "")

    grouped = lambda x: F.when(x.rlike(r"^[-+]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$"),
                               F.regexp_replace(x, ",", "")).otherwise(x)
    # plain decimals hold no markup
    return _with(c(col), lambda x: F.when(x.rlike(r"^[-+]?[0-9]+(\.[0-9]+)?$"), x).otherwise(_with(stripped(x), grouped)))


_PLAIN = r"^[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"
_RATIO = r"^([-+]?[0-9]+)/([0-9]+)$"
_FRAC = r"^([-+]?)\\frac\{([-+]?[0-9]+)\}\{([0-9]+)\}$"


def number(col) -> Column:
    """The value of a normalised answer that is a number, else null."""
    x = c(col)

    def ratio(top, bottom):
        low = bottom.cast("double")
        return F.when(low != 0, top.cast("double") / low)

    frac = ratio(F.regexp_extract(x, _FRAC, 2), F.regexp_extract(x, _FRAC, 3))
    return (F.when(x.rlike(_PLAIN), x.cast("double"))
            .when(x.rlike(_RATIO), ratio(F.regexp_extract(x, _RATIO, 1), F.regexp_extract(x, _RATIO, 2)))
            .when(x.rlike(_FRAC), F.when(F.regexp_extract(x, _FRAC, 1) == "-", -frac).otherwise(frac)))


def with_score(df: DataFrame, pred: str = "pred", gold: str = "gold", out: str = "score", precision: int = 5) -> DataFrame:
    """``df`` with 1 where an answer of ``pred`` equals one of ``gold``, else 0
    (H2). Both are answers or arrays of answers; each is normalised and read
    as a number once."""
    def read(name):
        one = c(name) if df.schema[name].dataType.typeName() == "array" else F.array(c(name))
        texts = F.transform(one, lambda x: normalised(x))
        return F.transform(texts, lambda x: F.struct(x.alias("text"), F.round(number(x), precision).alias("value")))

    def equal(p, g):
        both = p["value"].isNotNull() & g["value"].isNotNull()
        return F.coalesce(F.when(both, p["value"] == g["value"]).otherwise(p["text"] == g["text"]), F.lit(False))

    t = df.withColumn("_p", read(pred)).withColumn("_g", read(gold))
    hit = F.exists("_g", lambda g: F.exists("_p", lambda p: equal(p, g)))
    return t.withColumn(out, F.coalesce(hit, F.lit(False)).cast("int")).drop("_p", "_g")


def accuracy(df: DataFrame, by=("task", "checkpoint"), score_col: str = "score") -> DataFrame:
    """Mean score per task and checkpoint (H3)."""
    return df.groupBy(*by).agg(F.avg(score_col).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def grid(checkpoints: DataFrame, tasks=RUN_TASKS, checkpoint: str = "checkpoint") -> DataFrame:
    """Checkpoint x task evaluation grid (H4): each checkpoint row expands the
    fixed task list (a literal array), no join."""
    return checkpoints.select(checkpoint, F.explode(F.array(*[F.lit(t) for t in tasks])).alias("task"))


def layer_group(layer, size: int = 4) -> Column:
    """Sweep group of a 1-based layer number: layers 1-4 -> 0, 5-8 -> 1, ... (H4)."""
    return F.floor((c(layer) - 1) / size).cast("bigint")
