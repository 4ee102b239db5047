"""Feature health: which entries fire, tokens since each last fired, dead share.

The reference keeps one counter per entry, adds the step's token count
every step and zeroes the counters of entries that fired. After any step
the counter equals ``cum_tokens(now) - cum_tokens(last step it fired)``, so
the batch form needs only the last firing step per entry: an aggregate
with map-side partial combine (hot entries stay cheap) and one equi-join
with the entry table, never the dense entries x steps grid.

Counters at other steps are an as-of lookup: firings and questions (an entry
and a step each) are put in one order, and every question takes the last firing
before it, carried over the range partitions. The work grows with firings and
questions, whatever the number of steps between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.positions import max_before, prefix_sum

# Fixed value: default dead-entry threshold in tokens.
DEAD_FEATURE_THRESHOLD = 10_000_000


def fired(codes: DataFrame, by=("step",)) -> DataFrame:
    """Distinct ``(by..., latent_id)`` pairs: entries used in each step (F1)."""
    return codes.select(*by, "latent_id").distinct()


def step_tokens(rows: DataFrame, step: str = "step", tokens: str | None = None) -> DataFrame:
    """Tokens per step with their running total ``cum_tokens``.

    ``tokens`` names a per-row token count; by default every row is one token.
    """
    t = F.sum(tokens) if tokens else F.count(F.lit(1))
    per = rows.groupBy(step).agg(t.cast("bigint").alias("tokens"))
    return prefix_sum(per, [step], "tokens", "cum_tokens")


def last_fired(codes: DataFrame, steps: DataFrame, step: str = "step") -> DataFrame:
    """Per entry, the cumulative token count at the end of its last firing step."""
    f = fired(codes, (step,))
    return f.join(steps.select(step, "cum_tokens"), step).groupBy("latent_id") \
        .agg(F.max("cum_tokens").alias("last_cum"))


def total_tokens(steps: DataFrame) -> int:
    """All tokens seen so far: one aggregate, one number back to the driver."""
    return int(steps.agg(F.sum("tokens")).first()[0] or 0)


def since_from_last(entries: DataFrame, last: DataFrame, total: int) -> DataFrame:
    """``total - last_cum`` for every entry (never fired: ``total``); the total
    enters the plan as a literal, so no join is needed to attach it."""
    return (entries.select("latent_id").join(last, "latent_id", "left")
            .select("latent_id", (F.lit(total) - F.coalesce("last_cum", F.lit(0))).cast("bigint")
                    .alias("tokens_since_fired")))


def tokens_since_fired(codes: DataFrame, steps: DataFrame, entries: DataFrame,
                       step: str = "step") -> DataFrame:
    """Counter per entry after the last step (F2); never-fired entries count every token."""
    return since_from_last(entries, last_fired(codes, steps, step), total_tokens(steps))


def since_fired_at(codes: DataFrame, steps: DataFrame, questions: DataFrame, step: str = "step") -> DataFrame:
    """Counter after the step, for each of ``questions`` ``(step, latent_id)``
    (F2 per step): 0 if the entry fired in it, all tokens so far if it never
    did. Steps without rows in ``steps`` have no answer; equal questions are
    answered once."""
    f = fired(codes, (step,)).select(step, "latent_id", F.lit(0).alias("_ask"))
    q = questions.select(step, "latent_id", F.lit(1).alias("_ask")).distinct()
    both = f.unionByName(q).join(steps.select(step, "cum_tokens"), step)
    both = both.withColumn("_fired", F.when(F.col("_ask") == 0, F.col("cum_tokens")))
    told = max_before(both, "latent_id", [step, "_ask"], "_fired", "_last").where("_ask = 1")
    return told.select(step, "latent_id", (F.col("cum_tokens") - F.coalesce("_last", F.lit(0))).cast("bigint")
                       .alias("tokens_since_fired"))


def dead_at(codes: DataFrame, steps: DataFrame, entries: DataFrame, at: int,
            threshold: int = DEAD_FEATURE_THRESHOLD, step: str = "step") -> DataFrame:
    """Entries that are dead after step ``at`` (the dead set of the auxiliary
    loss of the next step, E11)."""
    asked = entries.select(F.lit(at).cast("bigint").alias(step), "latent_id")
    return dead_mask(since_fired_at(codes.where(F.col(step) <= at), steps, asked, step), threshold)


def dead_by_step(codes: DataFrame, steps: DataFrame, entries: DataFrame, at: list[int],
                 threshold: int = DEAD_FEATURE_THRESHOLD, step: str = "step") -> DataFrame:
    """Number and share of dead entries after each of the steps ``at``."""
    asked = entries.select(F.explode(F.array(*[F.lit(int(s)).cast("bigint") for s in at])).alias(step), "latent_id")
    dead = F.col("tokens_since_fired") > threshold
    return since_fired_at(codes, steps, asked, step).groupBy(step).agg(
        F.sum(dead.cast("bigint")).alias("n_dead"), F.avg(dead.cast("double")).alias("dead_share"))


def dead_mask(state: DataFrame, threshold: int = DEAD_FEATURE_THRESHOLD) -> DataFrame:
    """Entries whose counter is strictly greater than the threshold."""
    return state.where(F.col("tokens_since_fired") > threshold)


def dead_share(state: DataFrame, threshold: int = DEAD_FEATURE_THRESHOLD) -> DataFrame:
    """Number and share of dead entries."""
    dead = (F.col("tokens_since_fired") > threshold)
    return state.agg(F.sum(dead.cast("bigint")).alias("n_dead"), F.avg(dead.cast("double")).alias("dead_share"))
