"""Chat rendering edge cases."""

from pyspark.sql import functions as F

from tessera.operators import prompts as pr

MSG = "array<struct<role:string,content:string,tool_calls:array<struct<type:string,name:string,arguments:string>>>>"


def render(spark, msgs, **kw):
    df = spark.createDataFrame([(msgs,)], f"m {MSG}")
    return df.select(pr.render_reasoning_chat_array("m", **kw).alias("t")).first()["t"]


def call(name, args="{}"):
    return {"type": "function", "name": name, "arguments": args}


def test_system_hoisted_even_when_not_first(spark):
    t = render(spark, [{"role": "user", "content": "hi", "tool_calls": None},
                       {"role": "system", "content": "SYS", "tool_calls": None}], bos="<b>")
    assert t == "<b>SYS" + pr.R_USER + "hi"


def test_tool_run_closed_by_assistant_text_and_at_end(spark):
    msgs = [{"role": "user", "content": "q", "tool_calls": None},
            {"role": "assistant", "content": None, "tool_calls": [call("f", '{"a":1}'), call("g")]},
            {"role": "tool", "content": "r1", "tool_calls": None},
            {"role": "tool", "content": "r2", "tool_calls": None},
            {"role": "assistant", "content": "done", "tool_calls": None},
            {"role": "tool", "content": "late", "tool_calls": None}]
    t = render(spark, msgs, add_generation_prompt=True)
    calls = (pr.R_ASSISTANT + pr.R_CALLS_BEGIN + pr.R_CALL_BEGIN + "function" + pr.R_SEP + "f\n```json\n{\"a\":1}\n```"
             + pr.R_CALL_END + "\n" + pr.R_CALL_BEGIN + "function" + pr.R_SEP + "g\n```json\n{}\n```" + pr.R_CALL_END
             + pr.R_CALLS_END + pr.R_EOS)
    outs = pr.R_OUTPUTS_BEGIN + pr.R_OUTPUT_BEGIN + "r1" + pr.R_OUTPUT_END + "\n" + pr.R_OUTPUT_BEGIN + "r2" + pr.R_OUTPUT_END
    tail = pr.R_OUTPUTS_BEGIN + pr.R_OUTPUT_BEGIN + "late" + pr.R_OUTPUT_END + pr.R_OUTPUTS_END
    assert t == pr.R_USER + "q" + calls + outs + pr.R_OUTPUTS_END + "done" + pr.R_EOS + tail


def test_compat_mode_keeps_literal_quirks(spark):
    msgs = [{"role": "assistant", "content": None, "tool_calls": [call("f")]},
            {"role": "tool", "content": "r", "tool_calls": None}]
    t = render(spark, msgs, compat=True)
    # a single call never closes the calls block in the literal template
    assert pr.R_CALLS_END not in t
    assert t.endswith(pr.R_OUTPUTS_BEGIN + pr.R_OUTPUT_BEGIN + "r" + pr.R_OUTPUT_END + pr.R_OUTPUTS_END)


def test_conversation_starting_with_tool_output(spark):
    t = render(spark, [{"role": "tool", "content": "x", "tool_calls": None}])
    assert t == pr.R_OUTPUTS_BEGIN + pr.R_OUTPUT_BEGIN + "x" + pr.R_OUTPUT_END + pr.R_OUTPUTS_END


def test_empty_message_array(spark):
    assert render(spark, [], add_generation_prompt=True) == pr.R_ASSISTANT
    df = spark.createDataFrame([([],)], f"m {MSG}")
    assert df.select(pr.render_chat_array("m", add_generation_prompt=True).alias("t")).first()["t"] == ""


def test_simple_chat_skips_unknown_roles(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "tool", "zz"), (1, 2, "assistant", "b")],
                               "conv_id long, turn long, role string, text string")
    t = pr.render_chat(df, add_generation_prompt=True).first()["chat"]
    assert t == "<|user|>\na</s>\n<|assistant|>\nb</s>\n<|assistant|>\n"


def test_long_form_reasoning_chat_equals_array_form(spark):
    import numpy as np
    rng = np.random.default_rng(12)
    roles = ["user", "assistant", "tool", "system"]
    rows = []
    for conv in range(25):
        for turn in range(int(rng.integers(1, 9))):
            role = roles[int(rng.integers(0, 4))]
            calls = None
            content = f"c{conv}t{turn}"
            if role == "assistant" and rng.uniform() < 0.3:
                content, calls = None, [call(f"f{turn}", "{}")] * int(rng.integers(0, 3))
            rows.append((conv, turn * 3, role, content, calls))
    schema = ("conv_id long, turn long, role string, text string, "
              "calls array<struct<type:string,name:string,arguments:string>>")
    df = spark.createDataFrame(rows, schema)
    long_form = {r["conv_id"]: r["chat"] for r in
                 pr.render_reasoning_chat(df, tool_calls="calls", bos="<b>", add_generation_prompt=True).collect()}
    arrays = (df.groupBy("conv_id").agg(pr.F.array_sort(pr.F.collect_list(pr.F.struct(
        "turn", pr.F.col("role").alias("role"), pr.F.col("text").alias("content"),
        pr.F.col("calls").alias("tool_calls")))).alias("m")))
    arr = {r["conv_id"]: r["t"] for r in arrays.select(
        "conv_id", pr.render_reasoning_chat_array(pr.F.transform("m", lambda x: x.dropFields("turn")),
                                                  bos="<b>", add_generation_prompt=True).alias("t")).collect()}
    assert long_form == arr
