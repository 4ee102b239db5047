"""Chat formatting with cumulative-snapshot collapse.

A chat log may hold a conversation many times: a snapshot after each
exchange, each a prefix of the next. Only maximal conversations are rendered.
Built-in functions only.

Method. Turns are laid out in order of (conversation, turn) over range
partitions, so a conversation of any length is spread over tasks; a turn's
rank is its place in its piece plus the turns of earlier pieces. A turn's hash
covers its rank, role and text, and the hash of a prefix is the sum of its
turns' hashes (two sums of 64-bit hashes), which rolls from turn to turn and
carries over from piece to piece. The prefixes that some conversation goes on
from are reduced to distinct ones before they are shuffled, conversations to
distinct ones as well, and an anti-join leaves those that no longer one
begins with. Of equal conversations one stays (the smallest id). Only the
turns of what is left are rendered.

A rendered conversation is one row for each ``TURNS_PER_ROW`` turns (``part``
counts from 0), so that no row and no group grows without bound.

Defined results: turns are in order of turn, then role, then text, nulls
first; turn numbers themselves needn't match between snapshots; repeated rows
are repeated turns; a null role or text differs from an empty one and is
rendered as ``unknown`` or empty; rows without a conversation id are one
conversation; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, table

TURNS_PER_ROW = 512
OPEN, MIDDLE, CLOSE = "<|start|>", "\n", "<|end|>\n"


def _hash(seed: int, *columns):
    """Hash in which null and empty differ."""
    parts = [x for c in columns for x in (F.isnull(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return F.xxhash64(F.lit(seed), *parts)


def laid_out(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Turns in order, written once: ``key`` (conversation), ``piece`` (range
    partition) and ``place`` (ascending within the piece)."""
    named = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    keyed = named.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))).withColumn(
        "h1", _hash(1, "role", "text")).withColumn("h2", _hash(2, "role", "text"))
    ranged = (keyed.repartitionByRange(partitions(turns), "key", "turn", "h1")
              .sortWithinPartitions("key", "turn", "role", "text"))
    return materialise(ranged.withColumn("piece", F.spark_partition_id())
                       .withColumn("place", F.monotonically_increasing_id()), "turns")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`laid_out` with ``rank`` in the conversation, from 0."""
    parts = rows.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low"))
    # a conversation has at most one row per range partition here
    earlier = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("key", "piece", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(base, ["key", "piece"]).withColumn("rank", F.col("base") + F.col("place") - F.col("low")).drop("base", "low")


def _wide(col):
    return F.col(col).cast("decimal(20,0)")


def maximal(laid: DataFrame) -> DataFrame:
    """(key, n_turns, copies) of the conversations that no longer one begins
    with; of equal ones, the one with the smallest id."""
    turns = materialise(ranked(laid.select("conv_id", "key", "piece", "place", "h1", "h2"))
                        .withColumn("g1", F.xxhash64("rank", "h1")).withColumn("g2", F.xxhash64("rank", "h2"))
                        .drop("h1", "h2"), "ranks")
    local = Window.partitionBy("key", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("key", "piece").agg(F.sum(_wide("g1")).alias("t1"), F.sum(_wide("g2")).alias("t2"))
    earlier = Window.partitionBy("key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(30,0)")
    base = sums.select("key", "piece", F.coalesce(F.sum("t1").over(earlier), zero).alias("b1"),
                       F.coalesce(F.sum("t2").over(earlier), zero).alias("b2"))
    rolling = (turns.withColumn("l1", F.coalesce(F.sum(_wide("g1")).over(local), zero))
               .withColumn("l2", F.coalesce(F.sum(_wide("g2")).over(local), zero)).join(base, ["key", "piece"]))
    # what stands before a turn is a prefix that its conversation goes on from
    prefixes = rolling.where("rank > 0").select(
        F.col("rank").alias("n_turns"), (F.col("b1") + F.col("l1")).cast("decimal(38,0)").alias("f1"),
        (F.col("b2") + F.col("l2")).cast("decimal(38,0)").alias("f2")).distinct()
    whole = turns.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"),
        F.sum(_wide("g1")).cast("decimal(38,0)").alias("f1"), F.sum(_wide("g2")).cast("decimal(38,0)").alias("f2"))
    distinct = whole.groupBy("n_turns", "f1", "f2").agg(
        F.min(F.struct("conv_id", "key")).alias("first"), F.count(F.lit(1)).alias("copies"))
    return distinct.join(prefixes, ["n_turns", "f1", "f2"], "left_anti").select("first.key", "n_turns", "copies")


def render(turns: DataFrame, turns_per_row: int = TURNS_PER_ROW, **names) -> DataFrame:
    """(conv_id, part, n_turns, copies, text) of the maximal conversations."""
    laid = laid_out(turns, **names)
    kept = materialise(maximal(laid), "maximal")
    # few keys repeat on this side: one row per conversation; the other side's rows are spread by piece before
    own = ranked(laid.drop("h1", "h2").join(kept.select("key"), "key", "left_semi"))
    piece = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(CLOSE))
    parts = (own.withColumn("part", F.floor(F.col("rank") / turns_per_row).cast("bigint"))
             .groupBy("key", "part").agg(F.first("conv_id").alias("conv_id"),
                                         F.array_sort(F.collect_list(F.struct("rank", piece.alias("said")))).alias("said")))
    return parts.join(kept, "key").select("conv_id", "part", "n_turns", "copies",
                                          F.array_join(F.transform("said", lambda s: s["said"]), "").alias("text"))


def op3_chats(spark, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    return render(table(spark, sf_dir, "conversations"))


ORACLE = f"""
with turns as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) k
    from conversations),
c as (select conv_id, count(*) n, list({{'role': role, 'text': text}} order by k) said from turns group by conv_id),
d as (select min(conv_id) conv_id, n, said, count(*) copies from c group by n, said),
kept as (select * from d where not exists (select 1 from d e where e.n > d.n and e.said[1:d.n] = d.said))
select kept.conv_id, ((k - 1) // {TURNS_PER_ROW})::bigint part, any_value(n)::bigint n_turns, any_value(copies)::bigint copies,
    string_agg('{OPEN}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '{CLOSE[:-1]}' || chr(10), '' order by k) as text
from kept join turns on kept.conv_id is not distinct from turns.conv_id group by kept.conv_id, part"""
