"""Prompt and transcript construction (C1-C11), all as column expressions.

Only rendering that needs the order of a conversation's messages
(chat templates) aggregates; it groups by conversation, whose output is
one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c, seeded_hash

# ----------------------------------------------------------------------------
# Prompt texts, template markers and task bindings that must be
# reproduced exactly for identical output. Written as the intended text.
# ----------------------------------------------------------------------------

REASONING_FORMAT_SYSTEM_PROMPT = (
    "\nYou are a helpful AI Assistant that provides well-reasoned and detailed responses.\n"
    "You first think about the reasoning process as an internal monologue and then provide the user with the answer.\n"
    "Respond in the following format: <think>\n...\n</think>\n<answer>\n...\n</answer>\n"
)

BOXED_ANSWER_SYSTEM_PROMPT = (
    "\nA conversation between User and Assistant. The user asks a question, and the Assistant solves it.\n"
    "The assistant first thinks about the reasoning process in the mind and then provides the user with the answer, "
    "and put your final answer within \\boxed{} .\n"
    "The reasoning process and answer are enclosed within <think> </think> and <answer> </answer> tags, respectively, \n"
    "i.e., <think> reasoning process here </think> <answer> answer here </answer>.\n"
    "Note that respond by English, NOT use other languages.\n"
)

TUNING_SYSTEM_PROMPT = (
    "\nA conversation between User and Assistant. The user asks a question, and the Assistant solves it.\n"
    "The assistant first thinks about the reasoning process in the mind and then provides the user\n"
    "with the answer. The reasoning process and answer are enclosed within <think> </think> and\n"
    "<answer> </answer> tags, respectively, i.e., <think> reasoning process here </think>\n"
    "<answer> answer here </answer>.\n"
)

LENGTH_HINT = "\nThink for {n} tokens."

SFT_ASSISTANT = "think: \n{trace}\n answer: {answer}"

INSTRUCT_TEXT = "{system}User:\n {problem}\n\nAssistant:\n <think> {answer} </think>\n<answer> Answer: {answer}</answer>"

INSTRUCT_TEXT_PLACEHOLDER = "{system}User:\n {problem}\n\nAssistant:\n <think> Think </think>\n<answer> Answer </answer>"

FAMILY_MARKERS = {
    "Qwen": ("<|im_start|>think\n", "<|im_start|>answer\nAnswer: "),
    "Llama": ("<|start_header_id|>think\n", "<|start_header_id|>answer\nAnswer: "),
}

SIMPLE_CHAT_ROLES = ("system", "user", "assistant")
SIMPLE_CHAT_MESSAGE = "<|{role}|>\n{content}{eos}\n"
SIMPLE_CHAT_GENERATION = "<|assistant|>\n"
DEFAULT_EOS = "</s>"

MATH_QUERY_TEMPLATE = (
    "Solve the following math problem efficiently and clearly.  The last line of your response should be of the "
    "following format: 'Therefore, the final answer is: $\\boxed{ANSWER}$. I hope it is correct' (without quotes) "
    "where ANSWER is just the final number or expression that solves the problem. Think step by step before "
    "answering.\n\n{Question}"
)

CHOICE_QUERY_TEMPLATE = (
    "Answer the following multiple choice question. The last line of your response should be of the following "
    "format: 'Answer: $LETTER' (without quotes) where LETTER is one of ABCD. Think step by step before answering."
    "\n\n{Question}\n\nA) {A}\nB) {B}\nC) {C}\nD) {D}"
)

CHOICE_LETTERS = ("A", "B", "C", "D")

# task -> (question column, gold column)
EVAL_TASKS = {
    "math_500": ("problem", "solution"),
    "aime24": ("problem", "answer"),
    "aime25": ("problem", "answer"),
    "amc23": ("problem", "answer"),
    "minerva": ("problem", "solution"),
    "olympiadbench": ("question", "answer"),
}


# ----------------------------------------------------------------------------

def _fill(template: str, **cols) -> Column:
    """Substitute ``{name}`` placeholders of a fixed template by columns."""
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.group(1) not in cols:
            continue
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(c(cols[m.group(1)]))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def message(role, content) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), c(content).alias("content"))


def prompt_messages(df: DataFrame, system_prompt: str, problem: str = "problem",
                    out: str = "prompt") -> DataFrame:
    """System + user message array."""
    return df.withColumn(out, F.array(message("system", F.lit(system_prompt)), message("user", problem)))


def prompt_with_length(df: DataFrame, system_prompt: str, lo: int, hi: int, seed: int, key,
                       problem: str = "problem") -> DataFrame:
    """Length-conditioned prompt (C2): uniform integer target in [lo, hi] from a
    seeded hash of the row key, appended to the system text."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    target = (F.lit(lo) + F.pmod(seeded_hash(seed, *keys), F.lit(hi - lo + 1))).cast("bigint")
    system = F.concat(F.lit(system_prompt), F.lit("\nThink for "), target.cast("string"), F.lit(" tokens."))
    return (df.withColumn("target_length", target)
              .withColumn("prompt", F.array(message("system", system), message("user", problem))))


def sft_conversation(df: DataFrame, trace: str = "trace", answer: str = "answer",
                     question: str = "question", trace_free: bool = False) -> DataFrame:
    """User question + assistant ``think: ... answer: ...`` (C3); with
    ``trace_free`` the answer fills both slots (C4)."""
    body = _fill(SFT_ASSISTANT, trace=answer if trace_free else trace, answer=answer)
    return df.withColumn("messages", F.array(message("user", question), message("assistant", body)))


def instruct_text(df: DataFrame, problem: str = "problem", answer: str | None = "answer",
                  system_prompt: str = TUNING_SYSTEM_PROMPT, out: str = "text",
                  placeholder: bool = False) -> DataFrame:
    """Instruction text with the answer in both think and answer slots (C5);
    ``placeholder=True`` writes the fixed think/answer placeholders instead
    (the first-turn form of C6)."""
    if placeholder:
        return df.withColumn(out, _fill(INSTRUCT_TEXT_PLACEHOLDER, system=F.lit(system_prompt), problem=problem))
    return df.withColumn(out, _fill(INSTRUCT_TEXT, system=F.lit(system_prompt), problem=problem, answer=answer))


def instruct_text_from_conversation(df: DataFrame, conversations: str = "conversations",
                                    field: str = "value", system_prompt: str = TUNING_SYSTEM_PROMPT,
                                    out: str = "text") -> DataFrame:
    """Instruction text from a conversation's first turn, placeholder think/answer."""
    from tessera.operators.schema import first_field
    return df.withColumn(out, _fill(INSTRUCT_TEXT_PLACEHOLDER, system=F.lit(system_prompt),
                                    problem=first_field(conversations, field)))


def marked_conversation(df: DataFrame, family: str, question: str = "question",
                        trace: str = "trace", answer: str = "answer") -> DataFrame:
    """User question + assistant text with model-family think/answer markers."""
    fam = next((f for f in FAMILY_MARKERS if f in family), None)
    if fam is None:
        raise ValueError(f"Unknown model family: {family}")
    think, ans = FAMILY_MARKERS[fam]
    body = F.concat(F.lit(think), c(trace), F.lit(ans), c(answer))
    return df.withColumn("messages", F.array(message("user", question), message("assistant", body)))


# ---------------------------------------------------------------- chat rendering

def simple_chat_piece(role, content, eos: str = DEFAULT_EOS) -> Column:
    """Rendered text of one message under the simple template; other roles render empty."""
    r = c(role)
    return F.when(r.isin(*SIMPLE_CHAT_ROLES),
                  F.concat(F.lit("<|"), r, F.lit("|>\n"), F.coalesce(c(content), F.lit("")),
                           F.lit(eos + "\n"))).otherwise(F.lit(""))


def render_chat_array(messages, eos: str = DEFAULT_EOS, add_generation_prompt: bool = False) -> Column:
    """Simple chat rendering of an ``array<struct<role,content>>`` column."""
    body = F.array_join(F.transform(c(messages), lambda m: simple_chat_piece(m["role"], m["content"], eos)), "")
    if add_generation_prompt:
        body = F.when(F.size(c(messages)) > 0, F.concat(body, F.lit(SIMPLE_CHAT_GENERATION))).otherwise(body)
    return body


def render_chat(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                content: str = "text", eos: str = DEFAULT_EOS, add_generation_prompt: bool = False,
                out: str = "chat") -> DataFrame:
    """Render long-form messages ``(key, order, role, content)`` to one transcript per key.

    Each message is rendered by a column expression before the shuffle, so
    only the rendered pieces travel; the per-key concatenation is the
    output row itself. For conversations too long for a row see
    :func:`tessera.operators.transcripts.chat_parts`.
    """
    pieces = df.select(key, order, simple_chat_piece(role, content, eos).alias("_piece"))
    agg = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "_piece"))).alias("_p"))
    text = F.array_join(F.transform("_p", lambda p: p["_piece"]), "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(SIMPLE_CHAT_GENERATION))
    return agg.select(key, text.alias(out))


# Reasoning chat template markers (fixed values).
R_USER = "<｜User｜>"
R_ASSISTANT = "<｜Assistant｜>"
R_EOS = "<｜end▁of▁sentence｜>"
R_CALLS_BEGIN = "<｜tool▁calls▁begin｜>"
R_CALLS_END = "<｜tool▁calls▁end｜>"
R_CALL_BEGIN = "<｜tool▁call▁begin｜>"
R_CALL_END = "<｜tool▁call▁end｜>"
R_SEP = "<｜tool▁sep｜>"
R_OUTPUTS_BEGIN = "<｜tool▁outputs▁begin｜>"
R_OUTPUTS_END = "<｜tool▁outputs▁end｜>"
R_OUTPUT_BEGIN = "<｜tool▁output▁begin｜>"
R_OUTPUT_END = "<｜tool▁output▁end｜>"


def _tool_call_text(t) -> Column:
    return F.concat(t["type"], F.lit(R_SEP), t["name"], F.lit("\n```json\n"), t["arguments"],
                    F.lit("\n```" + R_CALL_END))


def _calls_text(calls) -> Column:
    """The closed calls block of a message; empty without calls."""
    calls = F.coalesce(calls, F.array().cast("array<struct<type:string,name:string,arguments:string>>"))
    joined = F.array_join(F.transform(calls, lambda t: F.concat(F.lit(R_CALL_BEGIN), _tool_call_text(t))), "\n")
    return F.when(F.size(calls) > 0, F.concat(F.lit(R_ASSISTANT + R_CALLS_BEGIN), joined,
                                              F.lit(R_CALLS_END + R_EOS))).otherwise(F.lit(""))


def reasoning_piece(role, content, calls, after_output) -> Column:
    """Text that one message adds under the reasoning template (C9);
    ``after_output``: the last user, assistant or tool message was a tool's."""
    said = F.coalesce(content, F.lit(""))
    close = F.when(after_output, F.lit(R_OUTPUTS_END)).otherwise(F.lit(""))
    return (F.when(role == "user", F.concat(close, F.lit(R_USER), said))
            .when((role == "assistant") & content.isNull(), F.concat(close, _calls_text(calls)))
            .when(role == "assistant", F.concat(F.when(after_output, F.lit(R_OUTPUTS_END)).otherwise(F.lit(R_ASSISTANT)),
                                                content, F.lit(R_EOS)))
            .when(role == "tool", F.concat(F.when(after_output, F.lit("\n")).otherwise(F.lit(R_OUTPUTS_BEGIN)),
                                           F.lit(R_OUTPUT_BEGIN), said, F.lit(R_OUTPUT_END)))
            .otherwise(F.lit("")))


def reasoning_tail(after_output, add_generation_prompt: bool = False) -> Column:
    """What follows the last message: an open output block is closed, else the generation prefix."""
    return F.when(after_output, F.lit(R_OUTPUTS_END)).otherwise(F.lit(R_ASSISTANT if add_generation_prompt else ""))


def render_reasoning_chat_array(messages, bos: str = "", add_generation_prompt: bool = False,
                                compat: bool = False) -> Column:
    """Reasoning-model chat rendering (C9) of a message array.

    Messages are ``struct<role, content, tool_calls array<struct<type,name,arguments>>>``.
    The last system message is hoisted to the front. Tool calls of an
    assistant message without content open a calls block; tool outputs form
    an output block closed by the next assistant text or at the end.

    Default: every calls block is closed after the last call of its message,
    an output block before the next user, call or text message, and the
    first-call/first-output flags reset per message. A null content of a user
    or tool message is empty. Each message is rendered beside the role of the
    one before it, in one pass.
    ``compat=True`` reproduces the literal upstream template text instead
    (block closed only from the second call on; flags never reset).
    """
    msgs = c(messages)
    system = F.coalesce(F.try_element_at(F.filter(msgs, lambda m: m["role"] == "system"), F.lit(-1))["content"],
                        F.lit(""))
    if compat:
        state = _literal_template(msgs)
        return F.concat(F.lit(bos), system, state["text"], reasoning_tail(state["is_tool"], add_generation_prompt))
    acting = F.filter(msgs, lambda m: m["role"].isin("user", "assistant", "tool"))
    before = F.concat(F.array(F.lit("")), F.transform(acting, lambda m: m["role"]))
    # one role more than messages: the last one meets no message and adds nothing
    pieces = F.zip_with(acting, before, lambda m, p: reasoning_piece(m["role"], m["content"], m["tool_calls"], p == "tool"))
    return F.concat(F.lit(bos), system, F.array_join(pieces, ""),
                    reasoning_tail(F.element_at(before, -1) == "tool", add_generation_prompt))


def _literal_template(msgs: Column) -> Column:
    """Text and open output block of the literal template, as one ``aggregate``
    over the messages: the first call ever opens the block, later calls are
    appended and each closes it; neither flag is ever reset."""
    init = F.struct(F.lit("").alias("text"), F.lit(False).alias("is_tool"),
                    F.lit(False).alias("is_first"), F.lit(True).alias("out_first"))

    def step(acc, m):
        role, content = m["role"], m["content"]
        said = F.coalesce(content, F.lit(""))
        calls = F.coalesce(m["tool_calls"], F.array().cast(
            "array<struct<type:string,name:string,arguments:string>>"))
        called = F.aggregate(
            calls, F.struct(F.lit("").alias("t"), acc["is_first"].alias("f")),
            lambda s, t: F.struct(
                F.concat(s["t"], F.when(~s["f"], F.concat(F.lit(R_ASSISTANT + R_CALLS_BEGIN + R_CALL_BEGIN),
                                                            _tool_call_text(t)))
                         .otherwise(F.concat(F.lit("\n" + R_CALL_BEGIN), _tool_call_text(t),
                                             F.lit(R_CALLS_END + R_EOS)))).alias("t"),
                F.lit(True).alias("f")))
        is_user = role == "user"
        is_call = (role == "assistant") & content.isNull()
        is_text = (role == "assistant") & content.isNotNull()
        is_out = role == "tool"
        piece = (F.when(is_user, F.concat(F.lit(R_USER), said))
                 .when(is_call, called["t"])
                 .when(is_text & acc["is_tool"], F.concat(F.lit(R_OUTPUTS_END), content, F.lit(R_EOS)))
                 .when(is_text, F.concat(F.lit(R_ASSISTANT), content, F.lit(R_EOS)))
                 .when(is_out & acc["out_first"], F.concat(F.lit(R_OUTPUTS_BEGIN + R_OUTPUT_BEGIN), said,
                                                           F.lit(R_OUTPUT_END)))
                 .when(is_out, F.concat(F.lit("\n" + R_OUTPUT_BEGIN), said, F.lit(R_OUTPUT_END)))
                 .otherwise(F.lit("")))
        is_tool = F.when(is_out, F.lit(True)).when(is_user | is_call | is_text, F.lit(False)).otherwise(acc["is_tool"])
        return F.struct(F.concat(acc["text"], piece).alias("text"), is_tool.alias("is_tool"),
                        F.when(is_call, called["f"]).otherwise(acc["is_first"]).alias("is_first"),
                        F.when(is_out, F.lit(False)).otherwise(acc["out_first"]).alias("out_first"))

    return F.aggregate(msgs, init, step)


def render_reasoning_chat(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                          content: str = "text", tool_calls: str | None = None, bos: str = "",
                          add_generation_prompt: bool = False, out: str = "chat") -> DataFrame:
    """Reasoning chat rendering (C9) of long-form messages: one exchange groups
    a conversation, whose text is one output row, and
    :func:`render_reasoning_chat_array` renders it. For conversations too long
    for a row see :func:`tessera.operators.transcripts.reasoning_chat_parts`."""
    msgs = messages_by_key(df, key, order, role, content, tool_calls=tool_calls)
    return msgs.select(key, render_reasoning_chat_array("messages", bos, add_generation_prompt).alias(out))


def messages_by_key(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                    content: str = "text", out: str = "messages", tool_calls: str | None = None) -> DataFrame:
    """Long-form rows to one ordered ``array<struct<role,content,tool_calls>>`` per key."""
    calls = F.col(tool_calls) if tool_calls else F.lit(None)
    m = F.struct(F.col(order).alias("_o"), F.col(role).alias("role"), F.col(content).alias("content"),
                 calls.cast("array<struct<type:string,name:string,arguments:string>>").alias("tool_calls"))
    agg = df.groupBy(key).agg(F.array_sort(F.collect_list(m)).alias("_m"))
    return agg.select(key, F.transform("_m", lambda x: x.dropFields("_o")).alias(out))


# ---------------------------------------------------------------- evaluation prompts

def eval_prompts(df: DataFrame, task: str) -> DataFrame:
    """Benchmark prompt (C10): math template around the task's question column,
    the gold column as the single choice, gold index 0."""
    if task not in EVAL_TASKS:
        raise ValueError(f"Unknown task: {task}")
    q, gold = EVAL_TASKS[task]
    return df.withColumns({
        "task": F.lit(task),
        "query": _fill(MATH_QUERY_TEMPLATE, Question=q),
        "choices": F.array(c(gold)),
        "gold_index": F.lit(0),
    })


def eval_prompts_many(df: DataFrame, tasks=None) -> DataFrame:
    """:func:`eval_prompts` for several tasks over one scan: each row expands
    the task list (a literal array) and picks its task's columns."""
    tasks = list(tasks or EVAL_TASKS)
    for t in tasks:
        if t not in EVAL_TASKS:
            raise ValueError(f"Unknown task: {t}")
    x = df.withColumn("task", F.explode(F.array(*[F.lit(t) for t in tasks])))

    def pick(i):
        out = None
        for t in tasks:
            col = F.col(EVAL_TASKS[t][i])
            out = F.when(F.col("task") == t, col) if out is None else out.when(F.col("task") == t, col)
        return out
    return x.withColumns({"query": _fill(MATH_QUERY_TEMPLATE, Question=pick(0)),
                          "choices": F.array(pick(1)), "gold_index": F.lit(0)})


def choice_prompts(df: DataFrame, seed: int, key: str, question: str = "Question",
                   correct: str = "Correct Answer",
                   wrong=("Incorrect Answer 1", "Incorrect Answer 2", "Incorrect Answer 3")) -> DataFrame:
    """Multiple-choice prompt (C11): correct answer inserted at a seeded index
    0-3 among the wrong ones; choices are the letters A-D, the instruction is the query."""
    gold = F.pmod(seeded_hash(seed, key), F.lit(4)).cast("int")
    opts = F.array_insert(F.array(*[c(w) for w in wrong]), gold + 1, c(correct))
    query = _fill(CHOICE_QUERY_TEMPLATE, Question=question, A=opts[0], B=opts[1], C=opts[2], D=opts[3])
    return df.withColumns({"query": query, "instruction": query, "choices": F.array(*[F.lit(x) for x in CHOICE_LETTERS]),
                           "gold_index": gold})
