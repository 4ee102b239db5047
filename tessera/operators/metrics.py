"""Run metrics and comparison aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import as_double_array, c, sq_norm, vshift
from tessera.operators.positions import min_before

CLIP_EPS = 1e-6  # fixed value: added to the norm before computing the clip coefficient


def metric_windows(df: DataFrame, freq: int, name: str = "name", step: str = "step",
                   value: str = "value") -> DataFrame:
    """Mean of each metric per logging period of ``freq`` steps (G1)."""
    period = F.floor(F.col(step) / freq).cast("bigint").alias("period")
    return df.groupBy(name, period).agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))


def epoch_mean(df: DataFrame, epoch: str = "epoch", value: str = "value") -> DataFrame:
    """Mean step loss per epoch."""
    return df.groupBy(epoch).agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))


def _sum(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def log_sum_exp(a) -> Column:
    """``log(sum(exp(x)))`` of a logits array, stabilised by the row maximum."""
    x = as_double_array(a)
    m = F.array_max(x)
    return m + F.log(_sum(F.transform(vshift(x, m), F.exp)))


def log_softmax(a) -> Column:
    """Numerically stable log-softmax of a logits array, inside one row."""
    x = as_double_array(a)
    return vshift(x, log_sum_exp(x))


def kl_row(teacher, student) -> Column:
    """``sum p (log p - log q)`` with p = softmax(teacher), q = softmax(student).

    Uses ``sum p = 1``: ``sum p (t - s) - lse(t) + lse(s)``, so every row
    scalar is computed once and each array is walked a constant number of
    times.
    """
    t, s = as_double_array(teacher), as_double_array(student)
    lse_t = log_sum_exp(t)
    p = F.transform(vshift(t, lse_t), F.exp)
    cross = _sum(F.zip_with(p, F.zip_with(t, s, lambda a, b: a - b), lambda a, b: a * b))
    return cross - lse_t + log_sum_exp(s)


def kl_divergence(teacher: DataFrame, student: DataFrame, keys, batch: str = "batch",
                  t_col: str = "teacher", s_col: str = "student") -> DataFrame:
    """KL(teacher || student) summed over positions and classes, divided by
    the number of sequences in the batch (the leading dimension only) (G3).

    Teacher and student rows meet in an equi-join on the position keys; the
    softmax of each row is computed inside the row, so no window is needed.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    j = teacher.select(*keys, batch, t_col).join(student.select(*keys, s_col), keys)
    return j.agg((F.sum(kl_row(t_col, s_col)) / F.countDistinct(batch)).alias("kl"))


def global_norm(df: DataFrame, vec: str) -> DataFrame:
    """L2 norm over all elements of all vectors."""
    return df.agg(F.sqrt(F.sum(sq_norm(as_double_array(vec)))).alias("norm"))


def clip_coefficient(norm, max_norm: float) -> Column:
    return F.least(F.lit(1.0), F.lit(float(max_norm)) / (c(norm) + F.lit(CLIP_EPS)))


def clip(df: DataFrame, vec: str, max_norm: float) -> DataFrame:
    """Scale every vector by ``min(1, max_norm / (global_norm + eps))``."""
    # one aggregate, one number back to the driver; it enters the plan as a literal
    coef = float(global_norm(df, vec).select(clip_coefficient("norm", max_norm)).first()[0])
    return df.withColumn(vec, F.transform(as_double_array(vec), lambda v: v * F.lit(coef)))


def every(df: DataFrame, n: int, step: str = "step", trainer_form: bool = False) -> DataFrame:
    """Every n-th step: ``step % n == 0``, or ``(step + 1) % n == 0`` in the trainer's form."""
    s = F.col(step) + 1 if trainer_form else F.col(step)
    return df.where(s % n == 0)


def best_so_far(df: DataFrame, save_every: int, by=("name",), step: str = "step",
                loss: str = "value") -> DataFrame:
    """Checkpoints a best-only saver keeps.

    Candidates are steps with ``(step + 1) % save_every == 0`` plus each
    group's final step; a candidate is kept when its loss is strictly below
    the loss of every earlier candidate of its group.
    """
    by = [by] if isinstance(by, str) else list(by)
    # both kinds of candidates are picked before anything is shuffled or joined
    due = (F.col(step) + 1) % save_every == 0
    last = df.groupBy(*by).agg(F.max_by(F.struct(*df.columns), F.col(step)).alias("_last")).select("_last.*")
    cand = df.where(due).unionByName(last.where(~due))
    prior = min_before(cand, by, [step], loss, "_prior")
    return prior.where(F.col("_prior").isNull() | (F.col(loss) < F.col("_prior"))).drop("_prior")


def latest_checkpoint(df: DataFrame, name: str = "name") -> DataFrame:
    """The ``checkpoint-N`` name with the highest N (G7); one row, null when none matches."""
    n = F.regexp_extract(name, r"^checkpoint-(\d+)$", 1)
    ok = df.where(n != "")
    return ok.agg(F.max_by(name, n.cast("bigint")).alias("latest"))
