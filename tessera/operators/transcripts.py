"""Chat transcripts of any length (C8, C9): rows ``(key, part, text)`` whose
texts, joined by ``part``, are the transcript.

What a message adds to its transcript depends on the messages before it only
by whether the last user, assistant or tool message was a tool output. Each
message is therefore a function of that one bit (keep it, set it, clear it),
and such functions compose. Messages are laid out in range pieces of ``(key,
order)``, so a long conversation spreads over many tasks; each task composes
its own messages in one pass, and the state and length that a conversation
brings into a piece come from one summary row a piece. Then every message
knows its state and its offset, is rendered by column expressions, is cut at
multiples of the part's length, and the slices meet in their part. No group
holds more than ``chars`` characters of text.

Results: part numbers are gapless from 0 and all parts but the last have
``chars`` characters; a conversation without text has one empty part. Null
texts, unknown roles, ties and null keys are treated as by the renderers of
whole conversations in :mod:`tessera.operators.prompts`: rows of one key and
order follow by role, text and calls. Other columns of the input are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import prompts as pr
from tessera.operators.positions import in_pieces

CHARS = 1 << 20
FRONT, MESSAGE, TAIL = 0, 1, 2  # where a row stands in its conversation
KEEPS, SETS, CLEARS = 0, 1, 2   # what a row does to the state
UNKNOWN = -1                    # state that an earlier piece decides


def chat_parts(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text",
               eos: str = pr.DEFAULT_EOS, add_generation_prompt: bool = False, out: str = "chat",
               chars: int = CHARS) -> DataFrame:
    """Simple chat rendering (C8) of long-form messages as parts of ``chars`` characters."""
    tail = F.lit(pr.SIMPLE_CHAT_GENERATION if add_generation_prompt else "")

    def text(r, after):
        return (F.when(F.col("_at") == MESSAGE, pr.simple_chat_piece(r["_role"], r["_content"], eos))
                .when(F.col("_at") == TAIL, tail).otherwise(F.lit("")))

    return _parts(_rows(df, key, order, role, content, None, F.lit(""), F.lit(KEEPS)), text, key, out, chars)


def reasoning_chat_parts(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                         content: str = "text", tool_calls: str | None = None, bos: str = "",
                         add_generation_prompt: bool = False, out: str = "chat", chars: int = CHARS) -> DataFrame:
    """Reasoning chat rendering (C9) of long-form messages as parts of ``chars`` characters."""
    kind = F.when(F.col(role) == "tool", SETS).when(F.col(role).isin("user", "assistant"), CLEARS).otherwise(KEEPS)

    def text(r, after):
        return (F.when(F.col("_at") == MESSAGE, pr.reasoning_piece(r["_role"], r["_content"], r["_calls"], after))
                .when(F.col("_at") == TAIL, pr.reasoning_tail(after, add_generation_prompt))
                .otherwise(r["_content"]))

    # the last system message stands in front: one row a key and task travels
    system = F.max(F.when(F.col(role) == "system", F.struct(F.col(order).alias("o"), F.col(content).alias("c"))))["c"]
    front = F.concat(F.lit(bos), F.coalesce(system, F.lit("")))
    return _parts(_rows(df, key, order, role, content, tool_calls, front, kind), text, key, out, chars)


def _rows(df, key, order, role, content, tool_calls, front, kind) -> DataFrame:
    """Messages, with a row before and a row after each conversation."""
    calls = "array<struct<type:string,name:string,arguments:string>>"
    messages = df.select(
        F.col(key).alias("_key"), F.lit(MESSAGE).alias("_at"), F.col(order).alias("_order"), F.col(role).alias("_role"),
        F.col(content).alias("_content"), (F.col(tool_calls) if tool_calls else F.lit(None)).cast(calls).alias("_calls"),
        kind.cast("int").alias("_kind"))
    ends = df.groupBy(F.col(key).alias("_key")).agg(front.alias("_front")).select(
        "_key", "_front", F.explode(F.array(F.lit(FRONT), F.lit(TAIL))).alias("_at"))
    ends = ends.select("_key", "_at", F.lit(None).cast(df.schema[order].dataType).alias("_order"),
                       F.lit(None).cast("string").alias("_role"), F.when(F.col("_at") == FRONT, F.col("_front")).alias("_content"),
                       F.lit(None).cast(calls).alias("_calls"), F.lit(KEEPS).alias("_kind"))
    return messages.unionByName(ends)


class _Run:
    """One task's pass over its sorted rows: each row's state before it and the
    characters of its conversation before it, both within the piece."""

    def __init__(self):
        self.key, self.any, self.first, self.state, self.chars = None, False, True, UNKNOWN, 0

    def add(self, key, kind, n0, n1):
        """Arrays for the next rows: ``first`` (in the piece's first
        conversation), ``after`` (state before the row), ``state`` (behind it),
        ``place`` (characters before it; an unknown state counts as clear)."""
        n = len(kind)
        i, ids = np.arange(n), np.asarray(key.dictionary_encode(null_encoding="encode").indices)
        starts = np.r_[not self.any or key[0].as_py() != self.key, ids[1:] != ids[:-1]]
        if not self.any:
            starts[0] = False  # the piece's first conversation may have begun before
        run = np.maximum.accumulate(np.where(starts, i, -1))
        first = (run < 0) & self.first
        acted = np.maximum.accumulate(np.where(kind != KEEPS, i, -1))
        before = np.r_[-1, acted[:-1]]

        def state_at(last):
            known = (last >= 0) & (last >= run)
            return np.where(known, kind[last] == SETS, np.where(run >= 0, 0, self.state))

        after, state = state_at(before), state_at(acted)
        size = np.where(after == 1, n1, n0)
        sums = np.cumsum(size) - size
        place = sums - np.where(run >= 0, sums[run], -self.chars)
        self.any, self.key, self.first = True, key[n - 1].as_py(), bool(first[-1])
        self.state, self.chars = int(state[-1]), int(place[-1] + size[-1])
        return first, after.astype(np.int32), state.astype(np.int32), place, place + size


_ADDED = "_piece int, _row bigint, _first boolean, _after int, _state int, _place bigint, _end bigint"


def _scan(batches):
    piece, row, run = TaskContext.get().partitionId(), 0, _Run()
    for b in batches:
        n = b.num_rows
        if n:
            first, after, state, place, end = run.add(*[b.column("_key")], *[np.asarray(b.column(c)) for c in ("_kind", "_n0", "_n1")])
            added = [pa.array(np.full(n, piece), pa.int32()), pa.array(row + np.arange(n), pa.int64()), pa.array(first),
                     pa.array(after, pa.int32()), pa.array(state, pa.int32()), pa.array(place, pa.int64()), pa.array(end, pa.int64())]
            names = [c.split()[0] for c in _ADDED.split(", ")]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, *names])
            row += n


def _carried(pieces) -> list[tuple]:
    """(piece, state, characters) that each piece's first conversation brings
    in, and the characters by which a set state shifts the rows behind its
    first acting message. ``pieces`` are the summary rows in order."""
    out, have, key, state, chars = [], False, None, 0, 0
    for p in pieces:
        s, n = (state, chars) if have and p["first"] == key else (0, 0)
        shift = p["delta"] if s == 1 else 0
        out.append((p["_piece"], s, n, shift))
        have, key, state, chars = True, p["last"], p["state"], p["end"]
        if p["one"]:
            state, chars = (s if state == UNKNOWN else state), n + chars + shift
    return out


def _parts(rows: DataFrame, text, key: str, out: str, chars: int) -> DataFrame:
    """Rows laid out, scanned, rendered by ``text(rows, state)`` and cut."""
    from tessera.session import scratch_path
    if chars < 1:
        raise ValueError("a part needs at least one character")
    spark = rows.sparkSession
    sized = rows.withColumns({"_n0": F.length(text(rows, F.lit(False))).cast("bigint"),
                              "_n1": F.length(text(rows, F.lit(True))).cast("bigint")})
    schema = sized.schema.simpleString()[len("struct<"):-1]
    path = scratch_path(spark, "transcripts")
    laid = in_pieces(sized, ["_key", "_at", "_order"], then=["_role", "_content", "_calls"])
    laid.mapInArrow(_scan, f"{schema}, {_ADDED}").write.parquet(path)
    laid = spark.read.parquet(path)

    # one row a piece passes the driver
    pieces = laid.groupBy("_piece").agg(
        F.min_by("_key", "_row").alias("first"), F.max_by("_key", "_row").alias("last"), F.bool_and("_first").alias("one"),
        F.max_by("_state", "_row").alias("state"), F.max_by("_end", "_row").alias("end"),
        F.sum(F.when(F.col("_after") == UNKNOWN, F.col("_n1") - F.col("_n0")).otherwise(0)).alias("delta")).orderBy("_piece")
    carry = spark.createDataFrame(_carried(pieces.collect()), "_piece int, _in int, _in_chars bigint, _shift bigint")

    j = laid.join(F.broadcast(carry), "_piece")
    after = F.when(F.col("_after") == UNKNOWN, F.col("_in")).otherwise(F.col("_after")) == 1
    brought = F.col("_in_chars") + F.when(F.col("_after") == UNKNOWN, 0).otherwise(F.col("_shift"))
    placed = j.select("_key", "_at", text(j, after).alias("_text"),
                      (F.col("_place") + F.when(F.col("_first"), brought).otherwise(0)).alias("_from"))
    n = F.length("_text")
    placed = placed.where((n > 0) | (F.col("_at") == TAIL)).withColumn("_to", F.col("_from") + n)

    def cut(p):
        begin = F.greatest(p * chars - F.col("_from"), F.lit(0))
        length = F.least((p + 1) * chars - F.col("_from"), F.col("_to") - F.col("_from")) - begin
        return F.struct(p.alias("part"), F.substring("_text", (begin + 1).cast("int"), length.cast("int")).alias("text"))

    # the row behind a conversation, when empty, joins the last part, so that every conversation has one
    last = F.floor(F.greatest(F.col("_to") - 1, F.lit(0)) / chars)
    span = F.sequence(F.least(F.floor(F.col("_from") / chars), last), last)
    slices = placed.select("_key", "_from", "_at", F.explode(F.transform(span, cut)).alias("_s"))
    grouped = slices.groupBy("_key", F.col("_s.part").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_from", "_at", "_s.text"))).alias("_p"))
    return grouped.select(F.col("_key").alias(key), "part", F.array_join(F.transform("_p", lambda p: p["text"]), "").alias(out))
