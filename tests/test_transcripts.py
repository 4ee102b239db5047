"""Transcripts in parts equal those of whole conversations, however they lie over tasks."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import prompts as pr
from tessera.operators import transcripts as tr

SCHEMA = ("conv_id string, turn int, role string, text string, "
          "calls array<struct<type:string,name:string,arguments:string>>, part int, _key int")


def joined(parts, chars):
    got = {}
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        got.setdefault(r["conv_id"], []).append(r["chat"])
        assert r["part"] == len(got[r["conv_id"]]) - 1
    for texts in got.values():
        assert all(len(t) == chars for t in texts[:-1]) and (texts[-1] or len(texts) == 1)
    return {k: "".join(v) for k, v in got.items()}


def messages(seed, n):
    rnd = random.Random(seed)
    for i in range(n):
        key = rnd.choice(["hot"] * 6 + ["a", "b", "", None])
        role = rnd.choice(["user", "assistant", "tool", "tool", "tool", "system", "other", None])
        text = rnd.choice([None, "", "é𝔘x", "word " * rnd.randrange(40), "q"])
        calls = [("function", "f", "{}")] * rnd.randrange(3) if role == "assistant" and text is None else None
        yield key, rnd.choice([None, i, i, i, i // 9]), role, text, calls, 5, 6


@pytest.mark.parametrize("seed,chars", [(1, 7), (2, 64), (3, 1000000)])
def test_parts_equal_whole_conversations(spark, seed, chars):
    df = spark.createDataFrame(list(messages(seed, 400)), SCHEMA).repartition(5)
    for gen in (True, False):
        whole = {r["conv_id"]: r["chat"] for r in pr.render_chat(df, add_generation_prompt=gen).collect()}
        assert joined(tr.chat_parts(df, add_generation_prompt=gen, chars=chars), chars) == whole
        whole = pr.render_reasoning_chat(df, tool_calls="calls", bos="<b>", add_generation_prompt=gen).collect()
        parts = tr.reasoning_chat_parts(df, tool_calls="calls", bos="<b>", add_generation_prompt=gen, chars=chars)
        assert joined(parts, chars) == {r["conv_id"]: r["chat"] for r in whole}


def test_empty_tables_and_conversations_without_text(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tr.chat_parts(none).count() == 0 and tr.reasoning_chat_parts(none, tool_calls="calls").count() == 0
    df = spark.createDataFrame([("x", 1, "other", "t", None, 0, 0)], SCHEMA)
    assert [tuple(r) for r in tr.chat_parts(df).collect()] == [("x", 0, "")]
    with pytest.raises(ValueError, match="character"):
        tr.chat_parts(df, chars=0)


def test_scan_is_the_same_however_rows_are_cut_into_pieces_and_batches():
    rnd = np.random.default_rng(5)
    key = np.sort(rnd.choice([0, 0, 0, 1, 2, 3], 300))
    kind = rnd.choice([tr.KEEPS, tr.KEEPS, tr.KEEPS, tr.SETS, tr.CLEARS], 300)
    n0 = np.where(kind == tr.KEEPS, 2, rnd.integers(0, 9, 300))
    n1 = np.where(kind == tr.KEEPS, 2, rnd.integers(0, 9, 300))
    want, now, state, chars = [], None, 0, 0
    for k, d, a, b in zip(key, kind, n0, n1):
        if k != now:
            now, state, chars = k, 0, 0
        want.append((state, chars))
        chars += b if state else a
        state = {tr.KEEPS: state, tr.SETS: 1, tr.CLEARS: 0}[d]
    for cuts in ([], [1, 2, 3], [10, 50, 51, 52, 200], sorted(rnd.choice(299, 40, False) + 1)):
        summaries, rows = [], []
        for p, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 300])):
            run, size, out = tr._Run(), int(rnd.integers(1, 30)), []
            for i in range(lo, hi, size):
                at = slice(i, min(hi, i + size))
                out.append(run.add(pa.array(key[at]), kind[at], n0[at], n1[at]))
            first, after, _, place, end = (np.concatenate(x) for x in zip(*out))
            summaries.append({"_piece": p, "first": key[lo], "last": key[hi - 1], "one": bool(first.all()),
                              "state": run.state, "end": run.chars,
                              "delta": int((n1 - n0)[lo:hi][after == tr.UNKNOWN].sum())})
            rows.append((first, after, place))
        got = []
        for (_, s, n, shift), (first, after, place) in zip(tr._carried(summaries), rows):
            for f, a, c in zip(first, after, place):
                got.append((s if a == tr.UNKNOWN else a, c + (n + (0 if a == tr.UNKNOWN else shift) if f else 0)))
        assert got == want


def test_a_million_turns_spread_over_tasks(spark):
    n = 1_000_000
    role = F.element_at(F.array(*[F.lit(r) for r in ("user", "assistant", "tool", "tool")]), (F.col("id") % 4 + 1).cast("int"))
    df = spark.range(n).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
                               F.col("id").cast("string").alias("text"))
    spread = tr.reasoning_chat_parts(df, add_generation_prompt=True)
    digest = lambda x: F.md5(x)
    got = spread.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "chat"))).alias("p"))
    got = got.select(digest(F.array_join(F.transform("p", lambda x: x["chat"]), "")), F.size("p")).first()
    whole, close = [], ""
    for i in range(n):
        piece = [pr.R_USER + str(i), pr.R_ASSISTANT + str(i) + pr.R_EOS,
                 pr.R_OUTPUTS_BEGIN + pr.R_OUTPUT_BEGIN + str(i) + pr.R_OUTPUT_END,
                 "\n" + pr.R_OUTPUT_BEGIN + str(i) + pr.R_OUTPUT_END][i % 4]
        whole.append(close + piece if i % 4 == 0 else piece)
        close = pr.R_OUTPUTS_END if i % 4 == 3 else close
    text = "".join(whole) + pr.R_OUTPUTS_END
    import hashlib
    assert got[0] == hashlib.md5(text.encode()).hexdigest() and got[1] == -(-len(text) // tr.CHARS)
