"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

Every computed column is aliased to the name used by the SQL oracle in
``tessera.plans.oracle``. Long constructed strings are reported as an md5
plus a length, so results compare cheaply.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import whitespace_tokens
from tessera.operators import positions as pos
from tessera.operators import prompts as pr
from tessera.operators import schema as sc
from tessera.operators import tokens as tk
from tessera.plans import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# Fixed parameters of the registered queries.
SEED = 42
CONV_CHUNK, CONV_BATCH_ROWS = 256, 32
DOC_CHUNK, DOC_BATCH_ROWS = 1024, 128
SHARDS = 7
BATCH_SIZE, MICRO_PIECES = 64, 3
RESUME_ROWS = 100
HEAD_ROWS = 100
GLOBS = ("model.layers.1*", "model.layers.[2-3]")
LAYER_STRIDE = 4
LENGTH_RANGE = (100, 4000)


def _md5_len(col, name: str):
    return [F.md5(col).alias(f"{name}_md5"), F.length(col).cast("bigint").alias(f"{name}_len")]


# ============================================================== D: tokens

@query("doc_token_counts")
def doc_token_counts(spark, d):
    return tk.token_lengths(fx.read(spark, d, "documents"), "text", ["doc_id"])


def _rounded(df):
    """All doubles to 6 decimals, for comparison."""
    return df.select(*[_r6(F.col(n), n) if t == "double" else F.col(n) for n, t in df.dtypes])


@query("doc_length_profile")
def doc_length_profile(spark, d):
    return _rounded(tk.length_profile(tk.token_lengths(fx.read(spark, d, "documents"), "text", ["doc_id"])))


@query("doc_length_by_lang")
def doc_length_by_lang(spark, d):
    docs = fx.read(spark, d, "documents")
    lens = docs.select("lang", F.size(whitespace_tokens("text")).cast("bigint").alias("n_tokens"))
    return _rounded(tk.length_profile(lens, by="lang"))


def _conversation_chunks(spark, d, return_final: bool):
    """Conversations rendered with the simple chat template, tokenised and packed.

    Messages stay rows: each is rendered and tokenised on its own (every
    rendered message ends in a newline, so whitespace tokens of the whole
    transcript are the concatenation of the per-message tokens) and packed
    as segments of its conversation; no conversation is collected.
    """
    conv = fx.read(spark, d, "conversations")
    msgs = conv.select("conv_id", "turn", whitespace_tokens(pr.simple_chat_piece("role", "text")).alias("tokens"))
    packed = tk.pack_segments(msgs, "tokens", ["conv_id"], ["turn"], chunk=CONV_CHUNK,
                              batch_rows=CONV_BATCH_ROWS, return_final=return_final)
    return tk.chunk_fingerprint(packed)


@query("pack_conversations")
def pack_conversations(spark, d):
    return _conversation_chunks(spark, d, False)


@query("pack_keep_final")
def pack_keep_final(spark, d):
    return _conversation_chunks(spark, d, True)


@query("pack_documents")
def pack_documents(spark, d):
    docs = tk.tokenize(fx.read(spark, d, "documents").select("doc_id", "text"), "text", "tokens")
    packed = tk.pack(docs, "tokens", ["doc_id"], chunk=DOC_CHUNK, batch_rows=DOC_BATCH_ROWS)
    return tk.chunk_fingerprint(packed)


@query("shuffle_docs")
def shuffle_docs(spark, d):
    return pos.shuffle(fx.read(spark, d, "documents").select("doc_id"), SEED, "doc_id")


@query("head_shuffled")
def head_shuffled(spark, d):
    docs = fx.read(spark, d, "documents").select("doc_id", "lang")
    return pos.head(docs, HEAD_ROWS, pos.shuffle_order(SEED, "doc_id"))


@query("shard_docs")
def shard_docs(spark, d):
    return pos.shard(fx.read(spark, d, "documents").select("doc_id"), SHARDS, None, ["doc_id"])


@query("resume_docs")
def resume_docs(spark, d):
    return pos.skip(fx.read(spark, d, "documents").select("doc_id"), RESUME_ROWS, ["doc_id"])


@query("batch_docs")
def batch_docs(spark, d):
    return pos.batch_ids(fx.read(spark, d, "documents").select("doc_id"), BATCH_SIZE, ["doc_id"]) \
        .select("doc_id", "batch")


@query("micro_chunks")
def micro_chunks(spark, d):
    b = pos.batch_ids(fx.read(spark, d, "documents").select("doc_id"), BATCH_SIZE, ["doc_id"])
    return pos.micro_chunks(b, MICRO_PIECES, "batch", ["doc_id"]).select("doc_id", "batch", "micro")


# ============================================================== B: schema

@query("first_turn")
def first_turn(spark, d):
    f = sc.first_message(fx.read(spark, d, "conversations"))
    return f.select("conv_id", F.col("role").alias("first_role"), F.md5("text").alias("first_md5"))


@query("json_answer")
def json_answer(spark, d):
    ev = fx.read(spark, d, "events")
    return ev.select("event_id", sc.json_answer("props", "$.k").alias("answer"))


@query("domain_filter")
def domain_filter(spark, d):
    docs = fx.read(spark, d, "documents")
    return sc.filter_domain(docs, "en", col="lang").select("doc_id", "n_chars")


@query("rename_problem")
def rename_problem(spark, d):
    p = sc.rename_if_missing(fx.pairs(spark, d), "problem", "question")
    p = sc.resolve_problem(p)
    return p.select("conv_id", "turn", F.md5("problem").alias("problem_md5"), F.md5("answer").alias("answer_md5"))


@query("resolve_trace")
def resolve_trace(spark, d):
    t = sc.resolve_trace(fx.trace_set(spark, d), "simplescaling/s1K")
    return t.select("conv_id", "turn", F.md5("trace").alias("trace_md5"), F.md5("answer").alias("answer_md5"))


@query("adapt_messages")
def adapt_messages(spark, d):
    """First message as the problem, ``$answer.value$`` from a JSON string
    (here carrying the conversation's message count)."""
    m = pr.messages_by_key(fx.read(spark, d, "conversations"))
    info = F.concat(F.lit('{"answer": {"value": '), F.size("messages").cast("string"), F.lit("}}"))
    a = sc.adapt_messages(m.withColumn("verification_info", info))
    return a.select("conv_id", F.md5("problem").alias("problem_md5"), "answer")


@query("union_splits")
def union_splits(spark, d):
    p = fx.pairs(spark, d).select("conv_id", "turn", "problem", "answer")
    # two complementary splits whose union is the whole table again
    train = p.where(F.col("conv_id") % 2 == 0).withColumn("split", F.lit("train"))
    test = p.where(F.col("conv_id") % 2 == 1).withColumn("split", F.lit("test"))
    u = sc.union_splits(train, test, require=("problem",))
    return u.select("conv_id", "turn", "split")


@query("layers_natural")
def layers_natural(spark, d):
    return sc.natural_rank(fx.module_names(spark, d), "name")


@query("layers_glob")
def layers_glob(spark, d):
    return sc.filter_glob(fx.layer_names(spark, d), "name", list(GLOBS))


@query("layers_stride")
def layers_stride(spark, d):
    return sc.stride(fx.layer_names(spark, d), LAYER_STRIDE, "name")


@query("layers_rename")
def layers_rename(spark, d):
    n = fx.layer_names(spark, d)
    return n.select("name", sc.rename_layer("name").alias("hookpoint"),
                    sc.layer_index(sc.rename_layer("name")).alias("layer"),
                    sc.hookpoint_of(F.concat(sc.rename_layer("name"), F.lit("/seed0"))).alias("base"))


# ============================================================== C: prompts

def _messages_md5(col):
    body = F.array_join(F.transform(col, lambda m: F.concat(m["role"], F.lit("\u0001"), m["content"])), "\u0002")
    return F.md5(body)


@query("prompt_messages")
def prompt_messages(spark, d):
    p = pr.prompt_messages(fx.pairs(spark, d), pr.REASONING_FORMAT_SYSTEM_PROMPT)
    return p.select("conv_id", "turn", F.size("prompt").cast("bigint").alias("n_messages"),
                    _messages_md5(F.col("prompt")).alias("prompt_md5"))


@query("prompt_length")
def prompt_length(spark, d):
    lo, hi = LENGTH_RANGE
    p = pr.prompt_with_length(fx.pairs(spark, d), pr.BOXED_ANSWER_SYSTEM_PROMPT, lo, hi, SEED, ["conv_id", "turn"])
    return p.select("conv_id", "turn", "target_length", _messages_md5(F.col("prompt")).alias("prompt_md5"))


PART_CHARS = 1000


def _sft(spark, d, trace_free: bool):
    t = sc.resolve_trace(fx.trace_set(spark, d), "simplescaling/s1K")
    s = pr.sft_conversation(t, trace_free=trace_free)
    return s.select("conv_id", "turn", *_md5_len(pr.render_chat_array("messages"), "text"))


@query("sft_trace")
def sft_trace(spark, d):
    return _sft(spark, d, False)


@query("sft_trace_free")
def sft_trace_free(spark, d):
    return _sft(spark, d, True)


@query("instruct_text")
def instruct_text(spark, d):
    t = pr.instruct_text(fx.pairs(spark, d))
    return t.select("conv_id", "turn", *_md5_len(F.col("text"), "text"))


@query("instruct_first_turn")
def instruct_first_turn(spark, d):
    f = sc.first_message(fx.read(spark, d, "conversations"), fields=("text",))
    t = pr.instruct_text(f.withColumnRenamed("text", "problem"), answer=None, placeholder=True)
    return t.select("conv_id", *_md5_len(F.col("text"), "text"))


@query("instruct_conversation")
def instruct_conversation(spark, d):
    t = pr.instruct_text_from_conversation(pr.messages_by_key(fx.read(spark, d, "conversations")), "messages", "content")
    return t.select("conv_id", *_md5_len(F.col("text"), "text"))


@query("marked_text")
def marked_text(spark, d):
    t = sc.resolve_trace(fx.trace_set(spark, d), "simplescaling/s1K", sae=True)
    m = pr.marked_conversation(t, "Qwen2.5-Math-1.5B")
    return m.select("conv_id", "turn", *_md5_len(pr.render_chat_array("messages"), "text"))


@query("chat_simple")
def chat_simple(spark, d):
    ch = pr.render_chat(fx.read(spark, d, "conversations"), add_generation_prompt=True)
    return ch.select("conv_id", *_md5_len(F.col("chat"), "chat"))


@query("chat_reasoning")
def chat_reasoning(spark, d):
    ch = pr.render_reasoning_chat(fx.read(spark, d, "conversations"), add_generation_prompt=True)
    return ch.select("conv_id", *_md5_len(F.col("chat"), "chat"))


@query("chat_reasoning_tools")
def chat_reasoning_tools(spark, d):
    ch = pr.render_reasoning_chat(fx.tool_conversations(spark, d), tool_calls="calls", add_generation_prompt=True)
    return ch.select("conv_id", *_md5_len(F.col("chat"), "chat"))


def _md5_parts(parts):
    return parts.select("conv_id", "part", *_md5_len(F.col("chat"), "chat"))


@query("chat_simple_parts")
def chat_simple_parts(spark, d):
    from tessera.operators.transcripts import chat_parts
    return _md5_parts(chat_parts(fx.read(spark, d, "conversations"), add_generation_prompt=True, chars=PART_CHARS))


@query("chat_reasoning_parts")
def chat_reasoning_parts(spark, d):
    from tessera.operators.transcripts import reasoning_chat_parts
    return _md5_parts(reasoning_chat_parts(fx.tool_conversations(spark, d), tool_calls="calls",
                                           add_generation_prompt=True, chars=PART_CHARS))


@query("eval_prompts")
def eval_prompts(spark, d):
    items = fx.benchmark_items(spark, d)
    return pr.eval_prompts_many(items).select(
        "task", "item_id", F.md5("query").alias("query_md5"), F.col("choices")[0].alias("gold"),
        F.col("gold_index").cast("int").alias("gold_index"))


@query("choice_prompts")
def choice_prompts(spark, d):
    c = pr.choice_prompts(fx.choice_items(spark, d), SEED, "item_id")
    return c.select("item_id", "gold_index", F.md5("query").alias("query_md5"),
                    F.array_join("choices", "").alias("letters"))


# ============================================================== E: sparse coding

AUXK_ALPHA = 1 / 32
DEAD_EVERY = 3          # fixture dead set: latent_id % 3 == 0
SKIP_SCALE = 0.1        # fixture skip matrix: 0.1 * encoder rows
STEP_ROWS = 50          # fixture step: vec_id div 50


def _r6(col, name):
    return F.round(col, 6).alias(name)


def _fw(spark, d, k=None, **kw):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d, **kw)
    data = fx.data_vectors(spark, d)
    return D, data, sp.forward(data, D, "vec_id", "vec", k=k)


@query("encode_topk")
def encode_topk(spark, d):
    from tessera.operators import sparse as sp
    codes = sp.encode(fx.data_vectors(spark, d), fx.dictionary(spark, d), "vec_id", "vec")
    return codes.select("vec_id", "latent_id", _r6(F.col("act"), "act"))


@query("encode_groupmax")
def encode_groupmax(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d, activation="groupmax")
    codes = sp.encode(fx.data_vectors(spark, d), D, "vec_id", "vec")
    return codes.select("vec_id", "latent_id", _r6(F.col("act"), "act"))


@query("forward_groupmax")
def forward_groupmax(spark, d):
    from tessera.functions.columns import array_md5
    _, _, fw = _fw(spark, d, activation="groupmax")
    return fw.select("vec_id", array_md5("recon").alias("recon_md5"))


@query("pre_activations")
def pre_activations(spark, d):
    from tessera.operators import sparse as sp
    pre = sp.pre_acts_long(fx.data_vectors(spark, d), fx.dictionary(spark, d), "vec_id", "vec")
    return pre.select("vec_id", "latent_id", _r6(F.col("act"), "act"))


@query("decode")
def decode(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    codes = sp.encode(fx.data_vectors(spark, d), D, "vec_id", "vec")
    return sp.decode(codes, D, "vec_id").select("vec_id", array_md5("recon").alias("recon_md5"))


@query("recon_mse")
def recon_mse(spark, d):
    from tessera.operators import sparse as sp
    _, _, fw = _fw(spark, d)
    return sp.recon_mse(fw).select(_r6(F.col("mse"), "mse"))


@query("fvu")
def fvu_query(spark, d):
    from tessera.operators import sparse as sp
    _, _, fw = _fw(spark, d)
    return sp.fvu(fw).select(_r6(F.col("fvu"), "fvu"), _r6(F.col("total_variance"), "total_variance"))


@query("fvu_by_step")
def fvu_by_step(spark, d):
    from tessera.operators import sparse as sp
    _, _, fw = _fw(spark, d)
    fw = fw.withColumn("step", F.floor(F.col("vec_id") / STEP_ROWS).cast("bigint"))
    return sp.fvu(fw, by="step").select("step", _r6(F.col("fvu"), "fvu"))


@query("fvu_multi")
def fvu_multi(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    return sp.losses(fx.data_vectors(spark, d), D, "vec_id", "vec", multi=4 * D.k).select(_r6(F.col("multi_fvu"), "multi_fvu"))


def _dead(D):
    # the fixture's dead set: every third entry
    return D.entries.select("latent_id").where(F.col("latent_id") % DEAD_EVERY == 0)


@query("auxk")
def auxk(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    a = sp.auxk_loss(fx.data_vectors(spark, d), D, _dead(D), "vec_id", "vec")
    return a.select(_r6(F.col("auxk"), "auxk"), "n_dead")


@query("total_loss")
def total_loss(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    t = sp.losses(fx.data_vectors(spark, d), D, "vec_id", "vec", dead=_dead(D), multi=4 * D.k, auxk_alpha=AUXK_ALPHA)
    return t.select(*[_r6(F.col(n), n) for n in ("fvu", "auxk", "multi_fvu", "total")])


@query("skip_decode")
def skip_decode(spark, d):
    from tessera.functions.columns import array_md5, vscale
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    # the skip matrix is a table of d rows (entry ids 0 to d - 1 of the fixture)
    D.w_skip = D.entries.where(F.col("latent_id") < D.d).select(
        F.col("latent_id").alias("row"), vscale("w_enc", SKIP_SCALE).alias("w"))
    fw = sp.forward(fx.data_vectors(spark, d), D, "vec_id", "vec")
    return fw.select("vec_id", array_md5("recon").alias("recon_md5"))


@query("transcode_pair")
def transcode_pair(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d, transcode=True)
    data = fx.data_vectors(spark, d).withColumn("sample_id", F.floor(F.col("vec_id") / 2).cast("bigint"))
    # even ids are inputs, the next odd id is the target
    pairs_ = sp.pair(data.where(F.col("vec_id") % 2 == 0).select("sample_id", "vec"),
                     data.where(F.col("vec_id") % 2 == 1).select("sample_id", "vec"), "sample_id")
    t = sp.losses(pairs_, D, "sample_id", "vec", "target")
    return _with_counts(t, pairs_)


def _with_counts(t, pairs_):
    """One-row results side by side: a union and a conditional aggregate, no join."""
    rows = (t.select(F.lit("fvu").alias("term"), F.round("fvu", 6).alias("v"))
            .unionByName(pairs_.agg(F.count("target").cast("double").alias("v")).withColumn("term", F.lit("n_pairs")))
            .unionByName(pairs_.agg(F.count(F.lit(1)).cast("double").alias("v")).withColumn("term", F.lit("n_inputs"))))
    return rows.agg(F.max(F.when(F.col("term") == "fvu", F.col("v"))).alias("fvu"),
                    *[F.max(F.when(F.col("term") == n, F.col("v"))).cast("bigint").alias(n) for n in ("n_pairs", "n_inputs")])


@query("reconstruct")
def reconstruct(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    out = sp.transform(fx.data_vectors(spark, d), fx.dictionary(spark, d), "vec")
    return out.select("vec_id", "label", array_md5("vec").alias("vec_md5"))


@query("unit_rows")
def unit_rows(spark, d):
    from tessera.functions.columns import array_md5, l2_norm
    from tessera.operators import sparse as sp
    u = sp.normalize_rows(fx.embedding_vectors(spark, d), "vec", out="w")
    return u.select("vec_id", _r6(l2_norm("w"), "norm"), array_md5("w").alias("w_md5"))


@query("remove_parallel")
def remove_parallel(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    # every vector's own direction as weight, its successor (if any) as gradient
    rows = sp.normalize_rows(fx.embedding_vectors(spark, d), "vec", out="w").select("vec_id", "w")
    grads = fx.embedding_vectors(spark, d).select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("g"))
    j = rows.join(grads, "vec_id", "left").withColumn("g", F.coalesce("g", F.transform("w", lambda v: v * 0)))
    return sp.remove_parallel(j, "g", "w").select("vec_id", array_md5("g").alias("g_md5"))


@query("mean_vector")
def mean_vector(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    m = sp.mean_vector(fx.embedding_vectors(spark, d), "vec", by="label")
    return m.select("label", array_md5("mean").alias("mean_md5"), "n_rows")


def _codes(spark, d):
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    return D, sp.encode(fx.data_vectors(spark, d), D, "vec_id", "vec")


@query("latent_index")
def latent_index(spark, d):
    from tessera.operators import sparse as sp
    _, codes = _codes(spark, d)
    return sp.latent_index(codes, "vec_id")


@query("latent_usage")
def latent_usage(spark, d):
    from tessera.operators import sparse as sp
    _, codes = _codes(spark, d)
    return sp.latent_usage(codes)


def _residual(spark, d):
    """Dictionary, codes and per-vector residual ``y - recon`` from one pass."""
    from tessera.functions.columns import vsub
    from tessera.operators import sparse as sp
    D = fx.dictionary(spark, d)
    fw = sp.forward(fx.data_vectors(spark, d), D, "vec_id", "vec", codes=True)
    codes = fw.select("vec_id", F.inline(F.arrays_zip(F.col("ids").alias("latent_id"), F.col("acts").alias("act"))))
    return D, codes, fw.select("vec_id", vsub("target", "recon").alias("grad"))


@query("latent_grad")
def latent_grad(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    D, codes, grad = _residual(spark, d)
    return sp.latent_grad(codes, grad, D.d, "vec_id").select("latent_id", array_md5("grad").alias("grad_md5"))


@query("code_grad")
def code_grad(spark, d):
    from tessera.operators import sparse as sp
    D, codes, grad = _residual(spark, d)
    return sp.code_grad(codes, grad, D, "vec_id").select("vec_id", "latent_id", _r6(F.col("grad_act"), "grad_act"))


# ============================================================== F: feature health

DEAD_THRESHOLD = 100


def _step_codes(spark, d):
    from tessera.operators import health as hl
    D, codes = _codes(spark, d)
    codes = codes.withColumn("step", F.floor(F.col("vec_id") / STEP_ROWS).cast("bigint"))
    steps = hl.step_tokens(fx.data_vectors(spark, d).withColumn(
        "step", F.floor(F.col("vec_id") / STEP_ROWS).cast("bigint")))
    return D, codes, steps


@query("fired")
def fired(spark, d):
    from tessera.operators import health as hl
    _, codes, _ = _step_codes(spark, d)
    return hl.fired(codes, ("step",))


@query("tokens_since_fired")
def tokens_since_fired(spark, d):
    from tessera.operators import health as hl
    D, codes, steps = _step_codes(spark, d)
    return hl.tokens_since_fired(codes, steps, D.entries)


@query("since_fired_by_step")
def since_fired_by_step(spark, d):
    """Counter of every entry after every step of the run."""
    from tessera.operators import health as hl
    D, codes, steps = _step_codes(spark, d)
    ends = steps.agg(F.min("step").alias("lo"), F.max("step").alias("hi")).first()  # one row
    asked = D.entries.select("latent_id", F.explode(F.sequence(F.lit(ends["lo"]), F.lit(ends["hi"]))).alias("step"))
    return hl.since_fired_at(codes, steps, asked)


@query("auxk_at_step")
def auxk_at_step(spark, d):
    """Auxiliary loss of one step's vectors on the entries that were dead after the step before it."""
    from tessera.operators import health as hl
    from tessera.operators import sparse as sp
    D, codes, steps = _step_codes(spark, d)
    step = int(steps.agg(F.max("step")).first()[0])
    dead = hl.dead_at(codes, steps, D.entries, step - 1, DEAD_LIST_THRESHOLD)
    rows = fx.data_vectors(spark, d).where(F.floor(F.col("vec_id") / STEP_ROWS) == step)
    a = sp.auxk_loss(rows, D, dead, "vec_id", "vec")
    return a.select(F.lit(step).cast("bigint").alias("step"), _r6(F.col("auxk"), "auxk"), "n_dead")


@query("dead_share")
def dead_share(spark, d):
    from tessera.operators import health as hl
    D, codes, steps = _step_codes(spark, d)
    s = hl.dead_share(hl.tokens_since_fired(codes, steps, D.entries), DEAD_THRESHOLD)
    return s.select("n_dead", _r6(F.col("dead_share"), "dead_share"))


# ============================================================== G: run metrics

METRIC_FREQ, EPOCH_STEPS, EVERY_N, SAVE_EVERY = 100, 1000, 100, 50
MAX_NORM = 1.0


@query("metric_windows")
def metric_windows(spark, d):
    from tessera.operators import metrics as mt
    m = mt.metric_windows(fx.metric_rows(spark, d), METRIC_FREQ)
    return m.select("name", "period", _r6(F.col("mean_value"), "mean_value"), "n")


@query("epoch_mean")
def epoch_mean(spark, d):
    from tessera.operators import metrics as mt
    rows = fx.metric_rows(spark, d).withColumn("epoch", F.floor(F.col("step") / EPOCH_STEPS).cast("bigint"))
    return mt.epoch_mean(rows).select("epoch", _r6(F.col("mean_value"), "mean_value"), "n")


@query("kl")
def kl(spark, d):
    from tessera.operators import metrics as mt
    emb = fx.read(spark, d, "embeddings")
    teacher = emb.select("vec_id", F.floor(F.col("vec_id") / STEP_ROWS).cast("bigint").alias("batch"),
                         F.col("embedding").alias("teacher"))
    student = emb.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("student"))
    return mt.kl_divergence(teacher, student, ["vec_id"]).select(_r6(F.col("kl"), "kl"))


@query("global_norm")
def global_norm(spark, d):
    from tessera.operators import metrics as mt
    n = mt.global_norm(fx.embedding_vectors(spark, d), "vec")
    return n.select(_r6(F.col("norm"), "norm"), _r6(mt.clip_coefficient("norm", MAX_NORM), "clip_coef"))


@query("clip_vectors")
def clip_vectors(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.operators import metrics as mt
    c_ = mt.clip(fx.embedding_vectors(spark, d), "vec", MAX_NORM)
    return c_.select("vec_id", array_md5("vec").alias("vec_md5"))


@query("every_n")
def every_n(spark, d):
    from tessera.operators import metrics as mt
    return mt.every(fx.metric_rows(spark, d), EVERY_N, trainer_form=True).select("step", "value")


@query("best_so_far")
def best_so_far(spark, d):
    from tessera.operators import metrics as mt
    return mt.best_so_far(fx.metric_rows(spark, d), SAVE_EVERY).select("name", "step", "value")


@query("latest_checkpoint")
def latest_checkpoint(spark, d):
    from tessera.operators import metrics as mt
    ev = fx.read(spark, d, "events")
    names = ev.select(F.concat(F.lit("checkpoint-"), F.floor(F.col("event_id") / 100).cast("string")).alias("name")) \
        .unionByName(ev.select(F.col("event_type").alias("name")))
    return mt.latest_checkpoint(names)


# ============================================================== H: evaluation

def _extracted(spark, d):
    from tessera.operators import evaluate as ev
    return fx.predictions(spark, d).withColumn("pred", ev.by_kind("kind", ev.extract_answer, "prediction")).withColumn(
        "gold", ev.by_kind("kind", ev.extract_gold, "gold_text"))


@query("extract_answer")
def extract_answer(spark, d):
    return _extracted(spark, d).select("l_orderkey", "l_linenumber", "task", "pred", "gold")


@query("score")
def score(spark, d):
    from tessera.operators import evaluate as ev
    return ev.with_score(_extracted(spark, d)).select("l_orderkey", "l_linenumber", "score")


@query("score_best")
def score_best(spark, d):
    """An order's lines of a task as one item with several predictions and golds."""
    from tessera.operators import evaluate as ev
    x = _extracted(spark, d).groupBy("l_orderkey", "task").agg(F.collect_set("pred").alias("pred"), F.collect_set("gold").alias("gold"))
    return ev.with_score(x).select("l_orderkey", "task", "score")


@query("accuracy")
def accuracy(spark, d):
    from tessera.operators import evaluate as ev
    return ev.accuracy(ev.with_score(_extracted(spark, d))).select("task", "checkpoint", _r6(F.col("accuracy"), "accuracy"), "n")


REWARD_LENGTH = 60  # words; the fixture's texts lie on both sides


def _scores(spark, d, *names):
    from tessera.operators import rewards as rw
    scored = rw.with_rewards(fx.completions(spark, d), weights={n: 1.0 for n in names}, max_length=REWARD_LENGTH)
    return scored.select("conv_id", "turn", *[_r6(F.col(f"{n}_score"), f"{n}_score") for n in names])


@query("reward_format")
def reward_format(spark, d):
    return _scores(spark, d, "format")


@query("reward_length")
def reward_length(spark, d):
    return _scores(spark, d, "length")


@query("reward_repetition")
def reward_repetition(spark, d):
    return _scores(spark, d, "repetition")


@query("reward")
def reward(spark, d):
    from tessera.operators import rewards as rw
    scored = rw.with_rewards(fx.completions(spark, d))
    return scored.select("conv_id", "turn", _r6(F.col("reward"), "reward"))


@query("grid")
def grid(spark, d):
    from tessera.operators import evaluate as ev
    return ev.grid(fx.predictions(spark, d).select("checkpoint").distinct())


@query("layer_groups")
def layer_groups(spark, d):
    from tessera.operators import evaluate as ev
    n = fx.layer_names(spark, d).withColumn("layer", sc.layer_index(sc.rename_layer("name")))
    n = n.where((F.col("layer") >= 1) & (F.col("layer") <= 26))
    return n.select("name", "layer", ev.layer_group("layer").alias("layer_group"))


# ============================================================== A: sources and sinks

BIN_CTX = 128
BIN_SHARD = (7, 3, 2)  # shards, the shard read, rows skipped in it
SEP_ID = 0
STATE_HOOKPOINTS = ("layers.0.mlp", "layers.1.mlp", "layers.2.mlp")
STATE_KEEP = ("layers.0.mlp", "layers.2.mlp")
DICT_HOOKPOINTS = ("layers.0.mlp", "layers.1.mlp", "layers.10.mlp", "layers.2.mlp")
DICT_PATTERN = "layers.1*"
DICT_STEP = 100


def _scratch(spark, name):
    from tessera.session import scratch_path
    return scratch_path(spark, name)


def _token_files(spark, d) -> str:
    """Packed documents as token files, in order; their folder."""
    from tessera.sources.token_bin import write_token_bin
    docs = fx.read(spark, d, "documents").select("doc_id", tk.hashed_ids(whitespace_tokens("text")).alias("ids"))
    packed = tk.pack(docs, "ids", ["doc_id"], chunk=BIN_CTX, batch_rows=DOC_BATCH_ROWS, separator=SEP_ID)
    path = _scratch(spark, "tokens")
    write_token_bin(packed, path, BIN_CTX, order=["batch", "chunk"])
    return path


def _token_rows(rows):
    return rows.select("idx", F.size("input_ids").cast("bigint").alias("n_tokens"),
                       F.md5(F.array_join(F.col("input_ids").cast("array<string>"), " ")).alias("chunk_md5"))


@query("token_bin")
def token_bin(spark, d):
    from tessera.sources.token_bin import read_token_bin
    return _token_rows(read_token_bin(spark, _token_files(spark, d), BIN_CTX))


@query("token_bin_shard")
def token_bin_shard(spark, d):
    from tessera.sources.token_bin import read_token_shard
    shards, shard, skip = BIN_SHARD
    return _token_rows(read_token_shard(spark, _token_files(spark, d), BIN_CTX, shards, shard, skip))


@query("scan_registry")
def scan_registry(spark, d):
    from tessera.sources.registry import DatasetRegistry
    reg = DatasetRegistry({"chats": f"{d}/conversations.parquet", "docs": f"{d}/documents.parquet"})
    return reg.scan(spark, "chats").groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query("pretokenised")
def pretokenised(spark, d):
    from tessera.sources.registry import scan_path
    path = _scratch(spark, "pretok")
    docs = fx.read(spark, d, "documents").select("doc_id", tk.hashed_ids(whitespace_tokens("text")).alias("input_ids"))
    docs.write.mode("overwrite").parquet(path)
    back = tk.tokenize(scan_path(spark, path), "text", "input_ids")  # present: passes through
    return back.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"),
                       F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda s, v: s + v).alias("id_sum"))


@query("state_merge")
def state_merge(spark, d):
    from tessera.operators import health as hl
    from tessera.sources.state_store import read_latent_state, write_latent_state
    D, codes, steps = _step_codes(spark, d)
    state = hl.tokens_since_fired(codes, steps, D.entries)
    path = _scratch(spark, "state")
    for w, hp in enumerate(STATE_HOOKPOINTS):  # module-parallel: one writer per hookpoint
        write_latent_state(state.withColumn("hookpoint", F.lit(hp)), path, w)
    return read_latent_state(spark, path, STATE_KEEP).select("hookpoint", "latent_id", "tokens_since_fired")


@query("dictionary_roundtrip")
def dictionary_roundtrip(spark, d):
    from tessera.functions.columns import array_md5
    from tessera.sources.dictionary_store import read_dictionaries, write_dictionary
    D = fx.dictionary(spark, d)
    path = _scratch(spark, "dicts")
    for hp in DICT_HOOKPOINTS:
        write_dictionary(D, path, hp, DICT_STEP)
    loaded = read_dictionaries(spark, path, pattern=DICT_PATTERN, decoder=False)
    out = None
    for hp, Dh in loaded.items():
        t = Dh.entries.select(F.lit(hp).alias("hookpoint"), "latent_id", array_md5("w_enc").alias("w_enc_md5"),
                              F.col("w_dec").isNull().alias("decoder_pruned"))
        out = t if out is None else out.unionByName(t)
    return out


@query("metrics_append")
def metrics_append(spark, d):
    from tessera.sources.state_store import append_metrics
    ev = fx.read(spark, d, "events").select(F.col("event_id").alias("step"), F.col("event_type").alias("name"),
                                            "value", F.col("user_id").cast("double").alias("user"))
    path = _scratch(spark, "metrics")
    append_metrics(ev.where(F.col("step") < 5000), path, ["step", "name"], ["value", "user"])
    append_metrics(ev.where(F.col("step") >= 5000), path, ["step", "name"], ["value", "user"])
    back = spark.read.parquet(path)
    return back.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), _r6(F.sum("value"), "total"))


@query("stream_since_fired")
def stream_since_fired(spark, d):
    from tessera.operators import health as hl
    from tessera.streaming.since_fired import last_fired_stream, since_fired_from_state
    D, codes, steps = _step_codes(spark, d)
    fires = hl.fired(codes, ("step",)).join(steps.select("step", "cum_tokens"), "step") \
        .select("step", "latent_id", F.col("cum_tokens").cast("bigint").alias("cum_tokens"))
    src, out, ckpt = _scratch(spark, "fires"), _scratch(spark, "state"), _scratch(spark, "stream-ckpt")
    fires.repartition(4, "step").write.mode("overwrite").parquet(src)
    state = last_fired_stream(spark, src, out, ckpt)
    return since_fired_from_state(state, D.entries, hl.total_tokens(steps))


# ============================================================== E19-E21: fitting

FIT_BATCHES, FIT_LR = 2, 0.01


def _fit_batch(data):
    """Rows per mini-batch: half of all vectors."""
    return -(-data.count() // FIT_BATCHES)


def _estimator(data, **more):
    from tessera.operators.fit import SparseDictionaryEstimator
    return SparseDictionaryEstimator(fx.DICT_ROWS, fx.K, batch_size=_fit_batch(data), lr=FIT_LR,
                                     dead_threshold=DEAD_THRESHOLD, **more)


def _fit_metrics(m):
    return m.select("step", "k", _r6(F.col("fvu"), "fvu"), _r6(F.col("dead_pct"), "dead_pct"), "n_rows")


@query("fit_dictionary")
def fit_dictionary(spark, d):
    """Two steps from the fixture dictionary, each over half of all vectors."""
    data = fx.data_vectors(spark, d)
    return _fit_metrics(_estimator(data).fit(data, "vec_id", "vec", init=fx.dictionary(spark, d)).metrics)


@query("fit_resume")
def fit_resume(spark, d):
    """The second of these steps by another estimator, from the stored dictionary and counters."""
    from tessera.sources.dictionary_store import read_dictionary, write_dictionary
    from tessera.sources.state_store import read_latent_state, write_latent_state
    data = fx.data_vectors(spark, d)
    res = _estimator(data).fit(data, "vec_id", "vec", init=fx.dictionary(spark, d), stop_step=1)
    path, state = _scratch(spark, "fit-dicts"), _scratch(spark, "fit-state")
    write_dictionary(res.dictionary, path, "layers.0.mlp", 1)
    write_latent_state(res.since_fired.withColumn("hookpoint", F.lit("layers.0.mlp")), state, writer=0)
    stored, since = read_dictionary(spark, path, "layers.0.mlp"), read_latent_state(spark, state, ["layers.0.mlp"])
    return _fit_metrics(_estimator(data).fit(data, "vec_id", "vec", init=stored, init_since=since, start_step=1).metrics)


FIT_SEEDS = (0, 1)


@query("fit_many")
def fit_many(spark, d):
    """Two groups (labels by parity) and two seeds at once, from the fixture
    dictionary, two mini-batches of half of the larger group."""
    from tessera.operators.fit import fit_many as run
    data = fx.data_vectors(spark, d).withColumn("hookpoint", F.concat(F.lit("layers."), (F.col("label") % 2)
                                                                      .cast("string"), F.lit(".mlp")))
    largest = data.groupBy("hookpoint").count().agg(F.max("count")).first()[0]
    m = run(data, "hookpoint", FIT_SEEDS, dict(num_latents=fx.DICT_ROWS, k=fx.K, batch_size=-(-largest // FIT_BATCHES), lr=FIT_LR,
                                               dead_threshold=DEAD_THRESHOLD), "vec_id", "vec", init=fx.dictionary(spark, d))
    return m.select("hookpoint", "seed", "step", "k", _r6(F.col("fvu"), "fvu"), _r6(F.col("dead_pct"), "dead_pct"), "n_rows")


@query("flatten_vectors")
def flatten_vectors(spark, d):
    """Sequences of the vectors of two consecutive ids (one, if the other is absent), flattened to one row per position."""
    from tessera.functions.columns import array_md5
    from tessera.operators import sparse as sp
    v = fx.embedding_vectors(spark, d).select(F.floor(F.col("vec_id") / 2).cast("bigint").alias("sample_id"), "vec_id", "vec")
    seqs = v.groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "vec"))),
                                                  lambda x: x["vec"]).alias("seq"))
    flat = sp.flatten_vectors(seqs, "seq", "sample_id")
    return flat.select("sample_id", F.col("pos").cast("bigint").alias("pos"), array_md5("vec").alias("vec_md5"))


DEAD_LIST_THRESHOLD = 25


@query("dead_latents")
def dead_latents(spark, d):
    from tessera.operators import health as hl
    D, codes, steps = _step_codes(spark, d)
    return hl.dead_mask(hl.tokens_since_fired(codes, steps, D.entries), DEAD_LIST_THRESHOLD)


EXPLICIT_LAYERS = (0, 2, 4, 10, 27)


@query("layers_explicit")
def layers_explicit(spark, d):
    return sc.select_hookpoints(fx.layer_names(spark, d), "name", layers=list(EXPLICIT_LAYERS))
