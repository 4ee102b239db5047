"""Independent SQL formulations of the registered queries, for DuckDB.

Tables are the driver's views. Parameters and fixed texts come from the
same constants as the Spark plans so that both sides state them once.
"""

from __future__ import annotations

from tessera.operators import prompts as pr
from tessera.operators import rewards as rw
from tessera.plans import queries as q

ORACLE: dict[str, str] = {}


def lit(s: str) -> str:
    """A DuckDB string expression equal to ``s`` (newlines via chr(10))."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "(" + " || chr(10) || ".join(quoted) + ")"


def shash(*keys: str, seed: int = q.SEED) -> str:
    inner = f"'{seed}'" + "".join(f" || ':' || CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x' || substr(md5({inner}), 1, 8))::UBIGINT::BIGINT)"


TOK = r"regexp_extract_all(text, '\S+')"

PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS problem, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

TRACES = PAIRS + """,
traces AS (SELECT conv_id, turn, problem AS question, answer AS trace,
                  split_part(answer, chr(10), 1) AS attempt FROM pairs)"""

NAMES = """names AS (SELECT DISTINCT 'model.layers.' || CAST(p_partkey % 28 AS VARCHAR) AS name FROM part)"""

MODULES = """names AS (SELECT DISTINCT 'model.layers.' || (p_partkey % 12) || CASE p_partkey % 3 WHEN 0 THEN '.self_attn'
  WHEN 1 THEN '.mlp.experts.' || (p_partkey % 11) ELSE '' END AS name FROM part)"""

# pieces in turn, as one text: every number padded to a fixed width and kept below all other characters
NATURAL = ("list_reduce(list_prepend('', list_transform(regexp_extract_all(name, '[0-9]+|[^0-9]+'), lambda x: "
           "CASE WHEN regexp_matches(x, '^[0-9]') THEN chr(1) || lpad(x, 30, '0') ELSE x END)), lambda a, b: a || b), name")


def simple_piece(role: str, content: str, eos: str = pr.DEFAULT_EOS) -> str:
    return (f"CASE WHEN {role} IN ('system', 'user', 'assistant') THEN '<|' || {role} || '|>' || chr(10) || "
            f"coalesce({content}, '') || {lit(eos + chr(10))} ELSE '' END")


def simple_pair(question: str, answer: str) -> str:
    return f"({simple_piece(chr(39) + 'user' + chr(39), question)} || {simple_piece(chr(39) + 'assistant' + chr(39), answer)})"


def md5_len(expr: str, name: str) -> str:
    return f"md5({expr}) AS {name}_md5, CAST(length({expr}) AS BIGINT) AS {name}_len"


def profile_select(n: str = "n") -> str:
    ps = ", ".join(f"round(quantile_cont({n}, {p}), 6) AS {nm}"
                   for p, nm in zip((0.5, 0.75, 0.9, 0.95, 0.99, 0.999), ("p50", "p75", "p90", "p95", "p99", "p999")))
    return (f"count({n}) AS n_rows, min({n}) AS min_len, max({n}) AS max_len, round(avg({n}), 6) AS mean_len, "
            f"round(stddev_pop({n}), 6) AS std_len, {ps}")


def pack_sql(source: str, key: str, chunk: int, batch_rows: int, return_final: bool,
             sep: str = "<|endoftext|>") -> str:
    """Brute-force packing: unnest every token with its position in its batch."""
    keep = f"(total + {chunk} - 1) // {chunk}" if return_final else f"(total - 1) // {chunk}"
    return f"""
WITH src AS ({source}),
toks AS (SELECT {key}, [{lit(sep)}] || {TOK} AS t, row_number() OVER (ORDER BY {key}) - 1 AS idx FROM src),
b AS (SELECT *, idx // {batch_rows} AS batch, len(t) AS n FROM toks),
s AS (SELECT *, sum(n) OVER (PARTITION BY batch ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start,
             sum(n) OVER (PARTITION BY batch) AS total FROM b),
u AS (SELECT batch, total, start + generate_subscripts(t, 1) - 1 AS p, unnest(t) AS tok FROM s)
SELECT CAST(batch AS BIGINT) AS batch, CAST(p // {chunk} AS BIGINT) AS chunk, count(*) AS n_tokens,
       md5(string_agg(tok, ' ' ORDER BY p)) AS chunk_md5
FROM u WHERE p // {chunk} < {keep}
GROUP BY batch, p // {chunk}"""


CHATS = f"""SELECT conv_id, string_agg({simple_piece('role', 'text')}, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""

# ============================================================== D

ORACLE["doc_token_counts"] = f"SELECT doc_id, CAST(len({TOK}) AS BIGINT) AS n_tokens FROM documents"

ORACLE["doc_length_profile"] = f"""
WITH l AS (SELECT CAST(len({TOK}) AS BIGINT) AS n FROM documents)
SELECT {profile_select()} FROM l HAVING count(n) > 0"""

ORACLE["doc_length_by_lang"] = f"""
WITH l AS (SELECT lang, CAST(len({TOK}) AS BIGINT) AS n FROM documents)
SELECT lang, {profile_select()} FROM l GROUP BY lang HAVING count(n) > 0"""

ORACLE["pack_conversations"] = pack_sql(CHATS, "conv_id", q.CONV_CHUNK, q.CONV_BATCH_ROWS, False)
ORACLE["pack_keep_final"] = pack_sql(CHATS, "conv_id", q.CONV_CHUNK, q.CONV_BATCH_ROWS, True)
ORACLE["pack_documents"] = pack_sql("SELECT doc_id, text FROM documents", "doc_id", q.DOC_CHUNK,
                                    q.DOC_BATCH_ROWS, False)

ORACLE["shuffle_docs"] = f"""
SELECT doc_id, row_number() OVER (ORDER BY {shash('doc_id')}, doc_id) - 1 AS shuffle_rank FROM documents"""

ORACLE["head_shuffled"] = f"""
SELECT doc_id, lang FROM documents ORDER BY {shash('doc_id')}, doc_id LIMIT {q.HEAD_ROWS}"""

ORACLE["shard_docs"] = f"""
SELECT doc_id, CAST(ntile({q.SHARDS}) OVER (ORDER BY doc_id) - 1 AS BIGINT) AS shard FROM documents"""

ORACLE["resume_docs"] = f"""
SELECT * FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents)
WHERE row_index >= {q.RESUME_ROWS}"""

ORACLE["batch_docs"] = f"""
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {q.BATCH_SIZE} AS batch FROM documents"""

ORACLE["micro_chunks"] = f"""
WITH b AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {q.BATCH_SIZE} AS batch FROM documents)
SELECT doc_id, batch,
       CAST(floor((row_number() OVER (PARTITION BY batch ORDER BY doc_id) - 1)
                  / ceil(count(*) OVER (PARTITION BY batch) / {q.MICRO_PIECES}.0)) AS BIGINT) AS micro
FROM b"""

# ============================================================== B

ORACLE["first_turn"] = """
SELECT conv_id, arg_min(role, turn) AS first_role, md5(arg_min(text, turn)) AS first_md5
FROM conversations GROUP BY conv_id"""

ORACLE["json_answer"] = "SELECT event_id, '$' || json_extract_string(props, '$.k') || '$' AS answer FROM events"

ORACLE["domain_filter"] = "SELECT doc_id, n_chars FROM documents WHERE lang = 'en'"

ORACLE["rename_problem"] = f"""WITH {PAIRS}
SELECT conv_id, turn, md5(problem) AS problem_md5, md5(answer) AS answer_md5 FROM pairs"""

ORACLE["resolve_trace"] = f"""WITH {TRACES}
SELECT conv_id, turn, md5(trace) AS trace_md5, md5(attempt) AS answer_md5 FROM traces"""

ORACLE["adapt_messages"] = """
SELECT conv_id, md5(arg_min(text, turn)) AS problem_md5, '$' || CAST(count(*) AS VARCHAR) || '$' AS answer
FROM conversations GROUP BY conv_id"""

ORACLE["union_splits"] = f"""WITH {PAIRS}
SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM pairs"""

ORACLE["layers_natural"] = f"""WITH {MODULES}
SELECT name, row_number() OVER (ORDER BY {NATURAL}) AS rank FROM names"""

ORACLE["layers_glob"] = f"""WITH {NAMES}
SELECT name FROM names WHERE {' OR '.join(f"name GLOB '{g}'" for g in q.GLOBS)}"""

ORACLE["layers_stride"] = f"""WITH {NAMES},
r AS (SELECT name, row_number() OVER (ORDER BY {NATURAL}) AS rank FROM names)
SELECT name, rank FROM r WHERE (rank - 1) % {q.LAYER_STRIDE} = 0"""

ORACLE["layers_rename"] = r"""WITH """ + NAMES + r""",
h AS (SELECT name, regexp_replace(name, 'model\.layers\.(\d+)', 'layers.\1.mlp') AS hookpoint FROM names)
SELECT name, hookpoint, CAST(regexp_extract(hookpoint, 'layers\.(\d+)', 1) AS BIGINT) AS layer,
       split_part(hookpoint || '/seed0', '/', 1) AS base FROM h"""

# ============================================================== C


def _msgs(*pairs_: tuple[str, str]) -> str:
    return " || chr(2) || ".join(f"'{r}' || chr(1) || {cnt}" for r, cnt in pairs_)


ORACLE["prompt_messages"] = f"""WITH {PAIRS}
SELECT conv_id, turn, CAST(2 AS BIGINT) AS n_messages,
       md5({_msgs(('system', lit(pr.REASONING_FORMAT_SYSTEM_PROMPT)), ('user', 'problem'))}) AS prompt_md5
FROM pairs"""

_lo, _hi = q.LENGTH_RANGE
ORACLE["prompt_length"] = f"""WITH {PAIRS},
t AS (SELECT *, {_lo} + {shash('conv_id', 'turn')} % {_hi - _lo + 1} AS target_length FROM pairs)
SELECT conv_id, turn, target_length,
       md5({_msgs(('system', lit(pr.BOXED_ANSWER_SYSTEM_PROMPT) + " || chr(10) || 'Think for ' || CAST(target_length AS VARCHAR) || ' tokens.'"), ('user', 'problem'))}) AS prompt_md5
FROM t"""

_sft_body = f"{lit('think: ' + chr(10))} || trace || {lit(chr(10) + ' answer: ')} || attempt"
_sft_free = f"{lit('think: ' + chr(10))} || attempt || {lit(chr(10) + ' answer: ')} || attempt"
ORACLE["sft_trace"] = f"""WITH {TRACES}
SELECT conv_id, turn, {md5_len(simple_pair('question', _sft_body), 'text')} FROM traces"""
ORACLE["sft_trace_free"] = f"""WITH {TRACES}
SELECT conv_id, turn, {md5_len(simple_pair('question', _sft_free), 'text')} FROM traces"""

_instr = (f"{lit(pr.TUNING_SYSTEM_PROMPT + 'User:' + chr(10) + ' ')} || problem || "
          f"{lit(chr(10) + chr(10) + 'Assistant:' + chr(10) + ' <think> ')} || answer || "
          f"{lit(' </think>' + chr(10) + '<answer> Answer: ')} || answer || '</answer>'")
ORACLE["instruct_text"] = f"""WITH {PAIRS}
SELECT conv_id, turn, {md5_len(_instr, 'text')} FROM pairs"""

_first = (f"{lit(pr.TUNING_SYSTEM_PROMPT + 'User:' + chr(10) + ' ')} || first || "
          f"{lit(chr(10) + chr(10) + 'Assistant:' + chr(10) + ' <think> Think </think>' + chr(10) + '<answer> Answer </answer>')}")
ORACLE["instruct_first_turn"] = f"""
WITH f AS (SELECT conv_id, arg_min(text, turn) AS first FROM conversations GROUP BY conv_id)
SELECT conv_id, {md5_len(_first, 'text')} FROM f"""

_think, _ans = pr.FAMILY_MARKERS["Qwen"]
_marked = f"{lit(_think)} || trace || {lit(_ans)} || attempt"
ORACLE["instruct_conversation"] = ORACLE["instruct_first_turn"]

ORACLE["marked_text"] = f"""WITH {TRACES}
SELECT conv_id, turn, {md5_len(simple_pair('question', _marked), 'text')} FROM traces"""

ORACLE["chat_simple"] = f"""
WITH c AS ({CHATS})
SELECT conv_id, {md5_len("text || " + lit(pr.SIMPLE_CHAT_GENERATION), 'chat')} FROM c"""

_reason_piece = (f"CASE role WHEN 'user' THEN '{pr.R_USER}' || text "
                 f"WHEN 'assistant' THEN '{pr.R_ASSISTANT}' || text || '{pr.R_EOS}' ELSE '' END")
ORACLE["chat_reasoning"] = f"""
WITH c AS (SELECT conv_id,
                  coalesce(arg_max(text, turn) FILTER (WHERE role = 'system'), '')
                  || string_agg({_reason_piece}, '' ORDER BY turn) || '{pr.R_ASSISTANT}' AS chat
           FROM conversations GROUP BY conv_id)
SELECT conv_id, {md5_len('chat', 'chat')} FROM c"""

_tool_chats = f"""
WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND turn % 4 >= 2 THEN 'tool' ELSE role END AS role, text AS raw,
                  role = 'assistant' AND conv_id % 3 = 0 AND turn % 4 = 1 AS is_call FROM conversations),
m AS (SELECT *, CASE WHEN is_call OR (conv_id % 5 = 0 AND turn % 4 = 0) THEN NULL ELSE raw END AS text FROM t),
l AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') = 'tool' AS after_tool FROM m WHERE role <> 'system'),
p AS (SELECT conv_id, turn, role, CASE
   WHEN role = 'tool' THEN CASE WHEN after_tool THEN chr(10) ELSE '{pr.R_OUTPUTS_BEGIN}' END || '{pr.R_OUTPUT_BEGIN}' || coalesce(text, '') || '{pr.R_OUTPUT_END}'
   ELSE CASE WHEN after_tool THEN '{pr.R_OUTPUTS_END}' ELSE '' END || CASE
     WHEN role = 'user' THEN '{pr.R_USER}' || coalesce(text, '')
     WHEN is_call THEN '{pr.R_ASSISTANT}{pr.R_CALLS_BEGIN}' || list_reduce(list_transform(['look', 'read'], lambda n: '{pr.R_CALL_BEGIN}function{pr.R_SEP}' || n
          || chr(10) || '```json' || chr(10) || '{{"turn": ' || turn || '}}' || chr(10) || '```{pr.R_CALL_END}'), lambda a, b: a || chr(10) || b)
          || '{pr.R_CALLS_END}{pr.R_EOS}'
     WHEN text IS NULL THEN ''
     ELSE CASE WHEN after_tool THEN '' ELSE '{pr.R_ASSISTANT}' END || text || '{pr.R_EOS}' END END AS piece FROM l),
c AS (SELECT conv_id, coalesce((SELECT arg_max(text, turn) FROM m s WHERE s.conv_id = p.conv_id AND role = 'system'), '')
             || string_agg(piece, '' ORDER BY turn) || CASE WHEN arg_max(role, turn) = 'tool' THEN '{pr.R_OUTPUTS_END}' ELSE '{pr.R_ASSISTANT}' END AS chat
      FROM p GROUP BY conv_id)"""
ORACLE["chat_reasoning_tools"] = f"{_tool_chats}\nSELECT conv_id, {md5_len('chat', 'chat')} FROM c"


def in_parts(chats: str) -> str:
    """Transcripts ``c(conv_id, chat)`` cut every so many characters."""
    n = q.PART_CHARS
    return f"""{chats},
s AS (SELECT conv_id, chat, unnest(range(greatest(1, (length(chat) + {n - 1}) // {n}))) AS part FROM c),
x AS (SELECT conv_id, part, substr(chat, CAST(part * {n} + 1 AS BIGINT), {n}) AS chat FROM s)
SELECT conv_id, part, {md5_len('chat', 'chat')} FROM x"""


ORACLE["chat_simple_parts"] = in_parts(
    f"WITH t AS ({CHATS}), c AS (SELECT conv_id, text || {lit(pr.SIMPLE_CHAT_GENERATION)} AS chat FROM t)")
ORACLE["chat_reasoning_parts"] = in_parts(_tool_chats)

_math_prefix = pr.MATH_QUERY_TEMPLATE.split("{Question}")[0]
ORACLE["eval_prompts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS task, item_id, md5({lit(_math_prefix)} || text) AS query_md5, "
    f"CAST(length(text) AS VARCHAR) AS gold, CAST(0 AS INTEGER) AS gold_index FROM benchmark"
    for t in pr.EVAL_TASKS)

_gq = pr.CHOICE_QUERY_TEMPLATE
_pre, _rest = _gq.split("{Question}")
ORACLE["choice_prompts"] = f"""
WITH i AS (
  SELECT b0.item_id, b0.text AS question, coalesce(b1.text, b0.text || ' (1)') AS correct, coalesce(b2.text, b0.text || ' (2)') AS w1,
         coalesce(b3.text, b0.text || ' (3)') AS w2, coalesce(b4.text, b0.text || ' (4)') AS w3,
         CAST({shash('b0.item_id')} % 4 AS INTEGER) AS g
  FROM benchmark b0 LEFT JOIN benchmark b1 ON b1.item_id = b0.item_id + 1
  LEFT JOIN benchmark b2 ON b2.item_id = b0.item_id + 2 LEFT JOIN benchmark b3 ON b3.item_id = b0.item_id + 3
  LEFT JOIN benchmark b4 ON b4.item_id = b0.item_id + 4),
o AS (SELECT item_id, question, g,
             CASE WHEN g = 0 THEN correct ELSE w1 END AS a,
             CASE WHEN g = 0 THEN w1 WHEN g = 1 THEN correct ELSE w2 END AS b,
             CASE WHEN g < 2 THEN w2 WHEN g = 2 THEN correct ELSE w3 END AS c,
             CASE WHEN g < 3 THEN w3 ELSE correct END AS d FROM i)
SELECT item_id, g AS gold_index,
       md5({lit(_pre)} || question || {lit(chr(10) + chr(10) + 'A) ')} || a || {lit(chr(10) + 'B) ')} || b
           || {lit(chr(10) + 'C) ')} || c || {lit(chr(10) + 'D) ')} || d) AS query_md5,
       'ABCD' AS letters
FROM o"""

# ============================================================== E

from tessera.plans import fixtures as fx  # noqa: E402

_EPS = 1.1920929e-07


def vec_ctes(k: int = fx.K, transcode: bool = False, dead: bool = False, groupmax: bool = False,
             data: str = "data") -> str:
    """Dictionary, decoder bias, pre-activations and codes as CTEs (cross join
    of vectors and entries is fine for the oracle, not for the engine)."""
    center = "data.v" if transcode else \
        "list_transform(generate_series(1, len(data.v)), lambda i: data.v[i] - bdec.b[i])"
    if groupmax:
        g = f"latent_id // (64 // {k})"
        rank = f"row_number() OVER (PARTITION BY vec_id, {g} ORDER BY act DESC, latent_id)"
        keep = "r = 1"
    else:
        rank = "row_number() OVER (PARTITION BY vec_id ORDER BY act DESC, latent_id)"
        keep = f"r <= {k}"
    where = f"WHERE latent_id % 3 = 0" if dead else ""
    return f"""
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
data AS (SELECT vec_id, label, v FROM emb WHERE vec_id >= {fx.DICT_ROWS}),
dict AS (SELECT vec_id AS latent_id, v AS w_enc, 0.0 AS b_enc,
                list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + {_EPS})) AS w_dec
         FROM emb WHERE vec_id < {fx.DICT_ROWS}),
bpos AS (SELECT p, avg(x) AS m FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS p FROM data) GROUP BY p),
bdec AS (SELECT list(m ORDER BY p) AS b FROM bpos),
pre AS (SELECT data.vec_id, dict.latent_id,
               greatest(list_inner_product({center}, dict.w_enc) + dict.b_enc, 0.0) AS act
        FROM {data} AS data, dict, bdec {where}),
codes AS (SELECT vec_id, latent_id, act FROM (SELECT *, {rank} AS r FROM pre) WHERE {keep}),
wdec AS (SELECT latent_id, unnest(w_dec) AS w, generate_subscripts(w_dec, 1) AS p FROM dict),
recon AS (SELECT c.vec_id, u.p, sum(c.act * u.w) + any_value(bdec.b[u.p]) AS h
          FROM codes c JOIN wdec u USING (latent_id), bdec GROUP BY c.vec_id, u.p),
err AS (SELECT r.vec_id, r.p, r.h, data.v[r.p] AS y FROM recon r JOIN {data} AS data USING (vec_id))"""


def fixed6(x: str) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(18,6)) AS VARCHAR)"


def list_md5(x: str, order: str = "p") -> str:
    return f"md5(string_agg({fixed6(x)}, ',' ORDER BY {order}))"


def fvu_of(err: str = "err") -> str:
    return f"""(SELECT sum(se) / sum(tv) FROM (SELECT var_pop(y) * count(y) AS tv, sum((y - h) * (y - h)) AS se
              FROM {err} GROUP BY p))"""


ORACLE["encode_topk"] = f"WITH {vec_ctes()} SELECT vec_id, latent_id, round(act, 6) AS act FROM codes"
ORACLE["encode_groupmax"] = f"WITH {vec_ctes(groupmax=True)} SELECT vec_id, latent_id, round(act, 6) AS act FROM codes"
ORACLE["forward_groupmax"] = f"WITH {vec_ctes(groupmax=True)} SELECT vec_id, {list_md5('h')} AS recon_md5 FROM recon GROUP BY vec_id"
ORACLE["pre_activations"] = f"WITH {vec_ctes()} SELECT vec_id, latent_id, round(act, 6) AS act FROM pre"
ORACLE["decode"] = f"WITH {vec_ctes()} SELECT vec_id, {list_md5('h')} AS recon_md5 FROM recon GROUP BY vec_id"
ORACLE["recon_mse"] = f"WITH {vec_ctes()} SELECT round(avg((y - h) * (y - h)), 6) AS mse FROM err"
ORACLE["fvu"] = f"""WITH {vec_ctes()},
pp AS (SELECT var_pop(y) * count(y) AS tv, sum((y - h) * (y - h)) AS se FROM err GROUP BY p)
SELECT round(sum(se) / sum(tv), 6) AS fvu, round(sum(tv), 6) AS total_variance FROM pp"""
ORACLE["fvu_by_step"] = f"""WITH {vec_ctes()},
pp AS (SELECT vec_id // {q.STEP_ROWS} AS step, p, var_pop(y) * count(y) AS tv, sum((y - h) * (y - h)) AS se
       FROM err GROUP BY vec_id // {q.STEP_ROWS}, p)
SELECT step, round(sum(se) / sum(tv), 6) AS fvu FROM pp GROUP BY step"""
ORACLE["fvu_multi"] = f"WITH {vec_ctes(k=4 * fx.K)} SELECT round({fvu_of()}, 6) AS multi_fvu"

_AUX = f"""WITH {vec_ctes()},
dead AS (SELECT count(*) AS n_dead FROM dict WHERE latent_id % {q.DEAD_EVERY} = 0),
par AS (SELECT n_dead, least(32, n_dead) AS k_aux, least(n_dead / 32.0, 1.0) AS scale FROM dead),
apre AS (SELECT p.* FROM pre p WHERE p.latent_id % {q.DEAD_EVERY} = 0),
acodes AS (SELECT vec_id, latent_id, act FROM
           (SELECT a.*, row_number() OVER (PARTITION BY vec_id ORDER BY act DESC, latent_id) AS r FROM apre a), par
           WHERE r <= par.k_aux),
ahat AS (SELECT c.vec_id, u.p, sum(c.act * u.w) + any_value(bdec.b[u.p]) AS eh
         FROM acodes c JOIN wdec u USING (latent_id), bdec GROUP BY c.vec_id, u.p),
aerr AS (SELECT e.p, e.y, e.y - e.h AS e, a.eh FROM err e JOIN ahat a USING (vec_id, p)),
aux AS (SELECT any_value(par.scale) * sum(se) / sum(tv) AS auxk, any_value(par.n_dead) AS n_dead FROM
        (SELECT var_pop(y) * count(y) AS tv, sum((eh - e) * (eh - e)) AS se FROM aerr GROUP BY p), par)"""
ORACLE["auxk"] = _AUX + "\nSELECT round(auxk, 6) AS auxk, CAST(n_dead AS BIGINT) AS n_dead FROM aux"

_MULTI = vec_ctes(k=4 * fx.K).replace("\nemb AS", "\nemb AS", 1)
ORACLE["total_loss"] = _AUX + f""",
mcodes AS (SELECT vec_id, latent_id, act FROM
           (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY act DESC, latent_id) AS r FROM pre) WHERE r <= {4 * fx.K}),
mrecon AS (SELECT c.vec_id, u.p, sum(c.act * u.w) + any_value(bdec.b[u.p]) AS h
           FROM mcodes c JOIN wdec u USING (latent_id), bdec GROUP BY c.vec_id, u.p),
merr AS (SELECT r.vec_id, r.p, r.h, data.v[r.p] AS y FROM mrecon r JOIN data USING (vec_id)),
t AS (SELECT {fvu_of()} AS fvu, {fvu_of('merr')} AS multi, (SELECT auxk FROM aux) AS auxk)
SELECT round(fvu, 6) AS fvu, round(auxk, 6) AS auxk, round(multi, 6) AS multi_fvu,
       round(fvu + {q.AUXK_ALPHA} * auxk + multi / 8, 6) AS total FROM t"""

ORACLE["skip_decode"] = f"""WITH {vec_ctes()},
skip AS (SELECT data.vec_id, s.latent_id + 1 AS p, {q.SKIP_SCALE} * list_inner_product(data.v, s.w_enc) AS sv
         FROM data, dict s)
SELECT r.vec_id, {list_md5('r.h + s.sv', 'r.p')} AS recon_md5
FROM recon r JOIN skip s ON s.vec_id = r.vec_id AND s.p = r.p GROUP BY r.vec_id"""

_TC = vec_ctes(transcode=True, data="xin").replace(
    "\nemb AS", "\nxin AS (SELECT vec_id // 2 AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings "
    f"WHERE vec_id >= {fx.DICT_ROWS} AND vec_id % 2 = 0),\n"
    "yt AS (SELECT vec_id // 2 AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings "
    f"WHERE vec_id >= {fx.DICT_ROWS} AND vec_id % 2 = 1),\nemb AS", 1)
_TC = _TC.replace("JOIN xin AS data USING (vec_id))", "JOIN yt AS data USING (vec_id))")
ORACLE["transcode_pair"] = f"""WITH {_TC},
pp AS (SELECT var_pop(y) * count(y) AS tv, sum((y - h) * (y - h)) AS se, count(*) AS n FROM err GROUP BY p)
SELECT round(sum(se) / sum(tv), 6) AS fvu, CAST(max(n) AS BIGINT) AS n_pairs, (SELECT count(*) FROM xin) AS n_inputs FROM pp"""

ORACLE["reconstruct"] = f"""WITH {vec_ctes()}
SELECT r.vec_id, any_value(data.label) AS label, {list_md5('r.h', 'r.p')} AS vec_md5
FROM recon r JOIN data USING (vec_id) GROUP BY r.vec_id"""

ORACLE["unit_rows"] = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + {_EPS})) AS w FROM e),
x AS (SELECT vec_id, unnest(w) AS z, generate_subscripts(w, 1) AS p FROM u)
SELECT vec_id, round(sqrt(sum(z * z)), 6) AS norm, {list_md5('z')} AS w_md5 FROM x GROUP BY vec_id"""

ORACLE["remove_parallel"] = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
j AS (SELECT e.vec_id, coalesce(n.v, list_transform(e.v, lambda x: x * 0)) AS g,
             list_transform(e.v, lambda x: x / (sqrt(list_sum(list_transform(e.v, lambda y: y * y))) + {_EPS})) AS w
      FROM e LEFT JOIN e n ON n.vec_id = e.vec_id + 1),
x AS (SELECT vec_id, unnest(g) AS gi, unnest(w) AS wi, generate_subscripts(g, 1) AS p,
             list_inner_product(g, w) AS gw FROM j)
SELECT vec_id, {list_md5('gi - gw * wi')} AS g_md5 FROM x GROUP BY vec_id"""

ORACLE["mean_vector"] = f"""
WITH d AS (SELECT label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS z, generate_subscripts(v, 1) AS p FROM d),
m AS (SELECT label, p, avg(z) AS mz, count(*) AS n FROM x GROUP BY label, p)
SELECT label, {list_md5('mz')} AS mean_md5, max(n) AS n_rows FROM m GROUP BY label"""

ORACLE["latent_index"] = f"""WITH {vec_ctes()}
SELECT latent_id, vec_id, row_number() OVER (PARTITION BY latent_id ORDER BY vec_id) - 1 AS slot FROM codes"""

ORACLE["latent_usage"] = f"""WITH {vec_ctes()},
u AS (SELECT latent_id, count(*) AS n_codes FROM codes GROUP BY latent_id)
SELECT latent_id, n_codes, CAST(coalesce(sum(n_codes) OVER (ORDER BY n_codes DESC, latent_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM u"""

ORACLE["latent_grad"] = f"""WITH {vec_ctes()},
g AS (SELECT c.latent_id, e.p, sum(c.act * (e.y - e.h)) AS s FROM codes c JOIN err e USING (vec_id)
      GROUP BY c.latent_id, e.p)
SELECT latent_id, {list_md5('s')} AS grad_md5 FROM g GROUP BY latent_id"""

ORACLE["code_grad"] = f"""WITH {vec_ctes()}
SELECT c.vec_id, c.latent_id, round(sum((e.y - e.h) * u.w), 6) AS grad_act
FROM codes c JOIN err e USING (vec_id) JOIN wdec u ON u.latent_id = c.latent_id AND u.p = e.p
GROUP BY c.vec_id, c.latent_id"""

# ============================================================== F

_SINCE = f"""WITH {vec_ctes()},
steps AS (SELECT vec_id // {q.STEP_ROWS} AS step, count(*) AS tokens FROM data GROUP BY 1),
cum AS (SELECT step, sum(tokens) OVER (ORDER BY step) AS cum FROM steps),
f AS (SELECT DISTINCT vec_id // {q.STEP_ROWS} AS step, latent_id FROM codes),
lastf AS (SELECT latent_id, max(cum) AS last_cum FROM f JOIN cum USING (step) GROUP BY latent_id),
tot AS (SELECT sum(tokens) AS total FROM steps),
since AS (SELECT d.latent_id, CAST(tot.total - coalesce(lastf.last_cum, 0) AS BIGINT) AS tokens_since_fired
          FROM dict d LEFT JOIN lastf USING (latent_id), tot)"""

ORACLE["fired"] = f"WITH {vec_ctes()} SELECT DISTINCT vec_id // {q.STEP_ROWS} AS step, latent_id FROM codes"
ORACLE["tokens_since_fired"] = _SINCE + "\nSELECT * FROM since"
ORACLE["since_fired_by_step"] = _SINCE + """,
grid AS (SELECT c.step, d.latent_id, c.cum, max(CASE WHEN f.step IS NOT NULL THEN c.cum END)
                OVER (PARTITION BY d.latent_id ORDER BY c.step) AS last
         FROM cum c CROSS JOIN dict d LEFT JOIN f ON f.step = c.step AND f.latent_id = d.latent_id)
SELECT step, latent_id, CAST(cum - coalesce(last, 0) AS BIGINT) AS tokens_since_fired FROM grid"""
ORACLE["dead_share"] = _SINCE + f"""
SELECT CAST(sum(CASE WHEN tokens_since_fired > {q.DEAD_THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS n_dead,
       round(avg(CASE WHEN tokens_since_fired > {q.DEAD_THRESHOLD} THEN 1.0 ELSE 0.0 END), 6) AS dead_share FROM since"""

# ============================================================== G

ORACLE["metric_windows"] = f"""
SELECT event_type AS name, event_id // {q.METRIC_FREQ} AS period, round(avg(value), 6) AS mean_value, count(*) AS n
FROM events GROUP BY 1, 2"""

ORACLE["epoch_mean"] = f"""
SELECT event_id // {q.EPOCH_STEPS} AS epoch, round(avg(value), 6) AS mean_value, count(*) AS n FROM events GROUP BY 1"""


def _log_softmax(x: str) -> str:
    return (f"list_transform({x}, lambda v: v - (list_max({x}) + "
            f"ln(list_sum(list_transform({x}, lambda w: exp(w - list_max({x})))))))")


ORACLE["kl"] = f"""
WITH t AS (SELECT vec_id, vec_id // {q.STEP_ROWS} AS batch, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
s AS (SELECT vec_id - 1 AS vec_id, CAST(embedding AS DOUBLE[]) AS y FROM embeddings),
j AS (SELECT t.batch, {_log_softmax('t.x')} AS lp, {_log_softmax('s.y')} AS lq FROM t JOIN s USING (vec_id))
SELECT round(sum(list_sum(list_transform(generate_series(1, len(lp)), lambda i: exp(lp[i]) * (lp[i] - lq[i]))))
             / count(DISTINCT batch), 6) AS kl FROM j"""

_NORM = f"""nrm AS (SELECT sqrt(sum(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda z: z * z)))) AS norm
               FROM embeddings)"""
ORACLE["global_norm"] = f"""WITH {_NORM}
SELECT round(norm, 6) AS norm, round(least(1.0, {q.MAX_NORM} / (norm + 1e-6)), 6) AS clip_coef FROM nrm"""

ORACLE["clip_vectors"] = f"""WITH {_NORM},
x AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS z, generate_subscripts(embedding, 1) AS p
      FROM embeddings)
SELECT vec_id, {list_md5('z * least(1.0, ' + str(q.MAX_NORM) + ' / (nrm.norm + 1e-6))')} AS vec_md5
FROM x, nrm GROUP BY vec_id"""

ORACLE["every_n"] = f"SELECT event_id AS step, value FROM events WHERE (event_id + 1) % {q.EVERY_N} = 0"

ORACLE["best_so_far"] = f"""
WITH m AS (SELECT event_type AS name, event_id AS step, value FROM events),
lst AS (SELECT name, max(step) AS ls FROM m GROUP BY name),
c AS (SELECT m.* FROM m JOIN lst USING (name) WHERE (m.step + 1) % {q.SAVE_EVERY} = 0 OR m.step = lst.ls),
p AS (SELECT *, min(value) OVER (PARTITION BY name ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
      FROM c)
SELECT name, step, value FROM p WHERE prior IS NULL OR value < prior"""

ORACLE["latest_checkpoint"] = r"""
WITH n AS (SELECT 'checkpoint-' || CAST(event_id // 100 AS VARCHAR) AS name FROM events
           UNION ALL SELECT event_type AS name FROM events)
SELECT arg_max(name, CAST(regexp_extract(name, '^checkpoint-(\d+)$', 1) AS BIGINT)) AS latest
FROM n WHERE regexp_extract(name, '^checkpoint-(\d+)$', 1) <> ''"""

# ============================================================== H

from tessera.operators import evaluate as ev  # noqa: E402

# answers are worked out from the numbers that the texts were made of, not read from the texts
_PRED = f"""
li AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, {shash('l_orderkey', 'l_linenumber')} % 10 AS h,
              (['aime24', 'aime25', 'amc23', 'math_500', 'minerva', 'olympiadbench', 'gpqa:diamond'])[l_orderkey % 7 + 1] AS task FROM lineitem),
k AS (SELECT *, q + CASE WHEN h < 3 THEN 1 ELSE 0 END AS said, l_orderkey % 7 < 3 AS expr, l_orderkey % 7 = 6 AS letter,
             'checkpoint-' || CAST(l_linenumber * 100 AS VARCHAR) AS checkpoint FROM li),
p AS (SELECT *, CASE WHEN letter THEN substr('ABCD', (l_linenumber + CASE WHEN h < 2 THEN 1 ELSE 0 END) % 4 + 1, 1)
        WHEN expr AND h = 6 THEN said || '00e-2' WHEN expr AND h = 8 THEN '+' || said
        WHEN expr AND h % 2 = 0 THEN CAST(said AS VARCHAR) WHEN expr THEN said || ',250'
        WHEN h % 3 = 0 AND h > 5 THEN said || '/2' WHEN h % 3 = 0 THEN '\\dfrac{{' || said || '}}{{2}}'
        WHEN h = 7 THEN '\\text{{x}}^' || repeat('{{', 20) || said || repeat('}}', 20)
        WHEN h % 3 = 1 THEN '\\text{{x}}^{{' || said || '}}' ELSE said || '500.0' END AS pred,
      CASE WHEN letter THEN substr('ABCD', l_linenumber % 4 + 1, 1)
        WHEN expr AND h % 2 = 0 THEN CAST(q AS VARCHAR) WHEN expr THEN q || ',250'
        WHEN h % 3 = 0 THEN '\\frac{{' || q || '}}{{2}}'
        WHEN h = 7 THEN 'x^' || repeat('{{', 20) || q || repeat('}}', 20) WHEN h % 3 = 1 THEN 'x^{{' || q || '}}' ELSE q || ',500' END AS gold FROM k),
s AS (SELECT *, CAST(CASE WHEN letter THEN h >= 2 ELSE said = q END AS INTEGER) AS score FROM p)"""
ORACLE["extract_answer"] = f"WITH {_PRED} SELECT l_orderkey, l_linenumber, task, pred, gold FROM s"
ORACLE["score"] = f"WITH {_PRED} SELECT l_orderkey, l_linenumber, score FROM s"
ORACLE["score_best"] = f"""WITH {_PRED},
v AS (SELECT *, CASE WHEN letter THEN ascii(pred) WHEN expr THEN CASE WHEN h % 2 = 0 THEN said ELSE said * 1000 + 250 END
        WHEN h % 3 = 0 THEN said / 2.0 WHEN h % 3 = 1 THEN -said ELSE said * 1000 + 500 END AS a,
      CASE WHEN letter THEN ascii(gold) WHEN expr THEN CASE WHEN h % 2 = 0 THEN q ELSE q * 1000 + 250 END
        WHEN h % 3 = 0 THEN q / 2.0 WHEN h % 3 = 1 THEN -q ELSE q * 1000 + 500 END AS b FROM s)
SELECT l_orderkey, task, CAST(list_has_any(list(CAST(a AS DOUBLE)), list(CAST(b AS DOUBLE))) AS INTEGER) AS score FROM v GROUP BY l_orderkey, task"""
ORACLE["accuracy"] = f"""WITH {_PRED}
SELECT task, checkpoint, round(avg(score), 6) AS accuracy, count(*) AS n FROM s GROUP BY task, checkpoint"""
ORACLE["grid"] = f"""WITH {_PRED}
SELECT checkpoint, unnest([{', '.join(repr(t) for t in ev.RUN_TASKS)}]) AS task FROM (SELECT DISTINCT checkpoint FROM p)"""
ORACLE["layer_groups"] = f"""WITH {NAMES},
l AS (SELECT name, CAST(regexp_extract(name, 'layers\\.(\\d+)', 1) AS BIGINT) AS layer FROM names)
SELECT name, layer, (layer - 1) // 4 AS layer_group FROM l WHERE layer BETWEEN 1 AND 26"""

_way = "(conv_id + turn) % 7"
_tagged = "'<think>' || answer || '</think>' || chr(10) || '<answer>' || problem || '</answer>'"
_COMPLETIONS = f"""WITH {PAIRS},
x AS (SELECT conv_id, turn, conv_id % 2 = 0 AS correct, coalesce(CASE {_way}
        WHEN 1 THEN answer WHEN 2 THEN {_tagged} || ' so' WHEN 3 THEN NULL
        WHEN 4 THEN '<think>' || answer || ' ' || answer || '</think><answer>x</answer>'
        WHEN 5 THEN '<think>' || answer || '</answer>' ELSE {_tagged} END, '') AS text FROM pairs),
w AS (SELECT *, {TOK} AS words, list_transform({TOK}, lambda t: lower(t)) AS lowered,
             CAST(regexp_full_match(text, '(?s)<think>.*</think>\\s*<answer>.*</answer>') AS INTEGER) AS f FROM x),
g AS (SELECT *, list_transform(range(1, greatest(len(words) - {rw.N_GRAM} + 2, 1)),
             lambda i: array_to_string(lowered[i:i + {rw.N_GRAM - 1}], ' ')) AS grams FROM w)"""
ORACLE["reward_format"] = f"{_COMPLETIONS} SELECT conv_id, turn, CAST(f AS DOUBLE) AS format_score FROM g"
ORACLE["reward_length"] = f"""{_COMPLETIONS}
SELECT conv_id, turn, round(CASE WHEN correct THEN {rw.MIN_CORRECT} ELSE {rw.MIN_WRONG} END
       + CASE WHEN correct THEN {rw.MAX_CORRECT - rw.MIN_CORRECT} ELSE {rw.MAX_WRONG - rw.MIN_WRONG} END
       * 0.5 * (1 + cos(pi() * least(len(words) / {q.REWARD_LENGTH}.0, 1))), 6) AS length_score FROM g"""
ORACLE["reward_repetition"] = f"""{_COMPLETIONS}
SELECT conv_id, turn, round(CASE WHEN len(grams) = list_unique(grams) THEN 0.0
       ELSE {rw.MAX_PENALTY} * (1 - list_unique(grams) / CAST(len(grams) AS DOUBLE)) END, 6) AS repetition_score FROM g"""
ORACLE["reward"] = f"""{_COMPLETIONS}
SELECT conv_id, turn, CAST({rw.WEIGHTS['accuracy']} * CAST(correct AS INTEGER) + {rw.WEIGHTS['format']} * f AS DOUBLE) AS reward FROM g"""

# ============================================================== A

_IDS = f"list_transform({TOK}, lambda t: CAST(('0x' || substr(md5(t), 1, 4)) AS INTEGER) % 65535 + 1)"

ORACLE["token_bin"] = f"""
WITH toks AS (SELECT doc_id, [{q.SEP_ID}] || {_IDS} AS t, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
b AS (SELECT *, idx // {q.DOC_BATCH_ROWS} AS batch, len(t) AS n FROM toks),
s AS (SELECT *, sum(n) OVER (PARTITION BY batch ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start,
             sum(n) OVER (PARTITION BY batch) AS total FROM b),
u AS (SELECT batch, total, start + generate_subscripts(t, 1) - 1 AS p, unnest(t) AS tok FROM s)
SELECT row_number() OVER (ORDER BY batch, p // {q.BIN_CTX}) - 1 AS idx, count(*) AS n_tokens,
       md5(string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY p)) AS chunk_md5
FROM u WHERE p // {q.BIN_CTX} < (total - 1) // {q.BIN_CTX}
GROUP BY batch, p // {q.BIN_CTX}"""

_shards, _shard, _skip = q.BIN_SHARD
ORACLE["token_bin_shard"] = f"""
WITH r AS ({ORACLE["token_bin"]}),
n AS (SELECT count(*) // {_shards} AS size, count(*) % {_shards} AS more FROM r),
b AS (SELECT size * {_shard} + least({_shard}, more) AS start, size + CAST({_shard} < more AS INTEGER) AS rows FROM n)
SELECT r.* FROM r, b WHERE idx >= start + {_skip} AND idx < start + rows"""

ORACLE["scan_registry"] = "SELECT role, count(*) AS n FROM conversations GROUP BY role"

ORACLE["pretokenised"] = f"""
SELECT doc_id, CAST(len({_IDS}) AS BIGINT) AS n_tokens, CAST(coalesce(list_sum({_IDS}), 0) AS BIGINT) AS id_sum
FROM documents"""

ORACLE["state_merge"] = _SINCE + f"""
SELECT h.hookpoint, s.latent_id, s.tokens_since_fired
FROM since s, (VALUES {', '.join(f"('{h}')" for h in q.STATE_KEEP)}) AS h(hookpoint)"""

ORACLE["dictionary_roundtrip"] = f"""
WITH e AS (SELECT vec_id AS latent_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id < {fx.DICT_ROWS}),
x AS (SELECT latent_id, unnest(v) AS z, generate_subscripts(v, 1) AS p FROM e),
m AS (SELECT latent_id, {list_md5('z')} AS w_enc_md5 FROM x GROUP BY latent_id),
h AS (SELECT hookpoint FROM (VALUES {', '.join(f"('{h}')" for h in q.DICT_HOOKPOINTS)}) AS t(hookpoint)
      WHERE hookpoint GLOB '{q.DICT_PATTERN}')
SELECT h.hookpoint, m.latent_id, m.w_enc_md5, true AS decoder_pruned FROM m, h"""

ORACLE["metrics_append"] = """
SELECT 'value' AS metric, count(*) AS n, round(sum(value), 6) AS total FROM events
UNION ALL SELECT 'user' AS metric, count(*) AS n, round(sum(CAST(user_id AS DOUBLE)), 6) AS total FROM events"""

ORACLE["stream_since_fired"] = ORACLE["tokens_since_fired"]

ORACLE["flatten_vectors"] = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT vec_id // 2 AS sample_id, list(v ORDER BY vec_id) AS seq FROM v GROUP BY vec_id // 2),
f AS (SELECT sample_id, unnest(seq) AS vec, generate_subscripts(seq, 1) - 1 AS pos FROM s),
x AS (SELECT sample_id, pos, unnest(vec) AS z, generate_subscripts(vec, 1) AS p FROM f)
SELECT sample_id, CAST(pos AS BIGINT) AS pos, {list_md5('z')} AS vec_md5 FROM x GROUP BY sample_id, pos"""

ORACLE["dead_latents"] = _SINCE + f"\nSELECT * FROM since WHERE tokens_since_fired > {q.DEAD_LIST_THRESHOLD}"

ORACLE["layers_explicit"] = f"""WITH {NAMES},
s AS (SELECT name FROM names
      WHERE CAST(regexp_extract(name, 'layers\\.(\\d+)', 1) AS BIGINT) IN ({', '.join(str(v) for v in q.EXPLICIT_LAYERS)}))
SELECT name, row_number() OVER (ORDER BY {NATURAL}) AS rank FROM s"""


# ============================================================== E19-E20


def _fit_step(n: int, batch: str, final: bool) -> str:
    """Forward pass of step ``n`` on its batch and, unless it is the last one,
    the sign update (element by element) that makes the parameters of the next."""
    x = f"""
x{n} AS (SELECT vec_id, v FROM numbered WHERE batch = {batch}),
pre{n} AS (SELECT x.vec_id, e.latent_id, greatest(list_inner_product(list_transform(generate_series(1, len(x.v)),
           lambda i: x.v[i] - b.b[i]), e.w_enc) + e.b_enc, 0.0) AS act FROM x{n} x, e{n} e, b{n} b),
codes{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY act DESC, latent_id) AS r FROM pre{n})
             WHERE r <= {fx.K}),
w{n} AS (SELECT latent_id, unnest(w_enc) AS we, unnest(w_dec) AS wd, generate_subscripts(w_dec, 1) AS p FROM e{n}),
recon{n} AS (SELECT c.vec_id, w.p, sum(c.act * w.wd) + any_value(b.b[w.p]) AS h FROM codes{n} c JOIN w{n} w USING (latent_id), b{n} b
             GROUP BY c.vec_id, w.p),
err{n} AS (SELECT r.vec_id, r.p, r.h, x.v[r.p] AS y, x.v[r.p] - b.b[r.p] AS xc FROM recon{n} r JOIN x{n} x USING (vec_id), b{n} b),
fvu{n} AS (SELECT sum(se) / sum(tv) AS fvu, max(n) AS n FROM (SELECT sum((h - y) * (h - y)) AS se, var_pop(y) * count(*) AS tv,
           count(*) AS n FROM err{n} GROUP BY p)),
hit{n} AS (SELECT DISTINCT latent_id FROM codes{n})"""
    if final:
        return x
    return x + f""",
slope{n} AS (SELECT c.vec_id, c.latent_id, CASE WHEN any_value(c.act) > 0 THEN sum(2 * (e.h - e.y) * w.wd) ELSE 0 END AS s
             FROM codes{n} c JOIN err{n} e USING (vec_id) JOIN w{n} w ON w.latent_id = c.latent_id AND w.p = e.p
             GROUP BY c.vec_id, c.latent_id),
g{n} AS (SELECT c.latent_id, e.p, sum(c.act * 2 * (e.h - e.y)) AS gd, sum(s.s * e.xc) AS ge FROM codes{n} c
         JOIN err{n} e USING (vec_id) JOIN slope{n} s ON s.vec_id = c.vec_id AND s.latent_id = c.latent_id GROUP BY c.latent_id, e.p),
along{n} AS (SELECT latent_id, sum(gd * wd) AS a FROM g{n} JOIN w{n} USING (latent_id, p) GROUP BY latent_id),
moved{n} AS (SELECT w.latent_id, w.p, w.we - {q.FIT_LR} * sign(coalesce(g.ge, 0)) AS we,
             w.wd - {q.FIT_LR} * sign(coalesce(g.gd - a.a * w.wd, 0)) AS wd
             FROM w{n} w LEFT JOIN g{n} g USING (latent_id, p) LEFT JOIN along{n} a USING (latent_id)),
norm{n} AS (SELECT latent_id, sqrt(sum(wd * wd)) + {_EPS} AS z FROM moved{n} GROUP BY latent_id),
eb{n} AS (SELECT latent_id, sum(s) AS g FROM slope{n} GROUP BY latent_id),
e{n + 1} AS (SELECT m.latent_id, list(m.we ORDER BY m.p) AS w_enc, list(m.wd / z.z ORDER BY m.p) AS w_dec,
             any_value(e.b_enc) - {q.FIT_LR} * sign(coalesce(any_value(b.g), 0)) AS b_enc
             FROM moved{n} m JOIN norm{n} z USING (latent_id) JOIN e{n} e USING (latent_id) LEFT JOIN eb{n} b USING (latent_id)
             GROUP BY m.latent_id),
gb{n} AS (SELECT p, sum(g) AS g FROM (SELECT p, 2 * (h - y) AS g FROM err{n} UNION ALL
          SELECT w.p, -s.s * w.we FROM slope{n} s JOIN w{n} w USING (latent_id)) GROUP BY p),
b{n + 1} AS (SELECT list(b.b[gb.p] - {q.FIT_LR} * sign(gb.g) ORDER BY gb.p) AS b FROM gb{n} gb, b{n} b)"""


def _fit(where: str, size: str) -> str:
    """Two steps on the vectors ``where``, in batches of ``size``."""
    return f"""WITH {vec_ctes()},
numbered AS (SELECT vec_id, v, (row_number() OVER (ORDER BY vec_id) - 1) // {size} AS batch
             FROM data WHERE {where}),
e0 AS (SELECT latent_id, w_enc, b_enc, list_transform(w_dec, lambda x: x / (sqrt(list_sum(list_transform(w_dec, lambda y: y * y))) + {_EPS})) AS w_dec
       FROM dict),
b0 AS (SELECT b FROM bdec),{_fit_step(0, "0", False)},{_fit_step(1, "1", True)},
since AS (SELECT d.latent_id, CASE WHEN h0.latent_id IS NULL THEN f0.n ELSE 0 END AS s0,
          CASE WHEN h1.latent_id IS NOT NULL THEN 0 WHEN h0.latent_id IS NULL THEN f0.n + f1.n ELSE f1.n END AS s1
          FROM dict d LEFT JOIN hit0 h0 USING (latent_id) LEFT JOIN hit1 h1 ON h1.latent_id = d.latent_id, fvu0 f0, fvu1 f1),
told AS (SELECT 0 AS step, fvu, n, (SELECT avg(CASE WHEN s0 > {q.DEAD_THRESHOLD} THEN 1.0 ELSE 0 END) FROM since) AS dead FROM fvu0
         UNION ALL SELECT 1, fvu, n, (SELECT avg(CASE WHEN s1 > {q.DEAD_THRESHOLD} THEN 1.0 ELSE 0 END) FROM since) FROM fvu1)
SELECT CAST(step AS BIGINT) AS step, CAST({fx.K} AS BIGINT) AS k, round(fvu, 6) AS fvu, round(dead, 6) AS dead_pct,
       CAST(n AS BIGINT) AS n_rows FROM told"""


_FIT = _fit("true", f"CAST(ceil(count(*) OVER () / {q.FIT_BATCHES}.0) AS BIGINT)")
ORACLE["fit_dictionary"] = _FIT
ORACLE["fit_resume"] = _FIT + " WHERE step = 1"

# Each group on its own, the same from every seed as all start from one dictionary
_LARGEST = f"""CAST(ceil((SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings WHERE vec_id >= {fx.DICT_ROWS}
              GROUP BY label % 2)) / {q.FIT_BATCHES}.0) AS BIGINT)"""
ORACLE["fit_many"] = "\nUNION ALL ".join(
    f"SELECT 'layers.{g}.mlp' AS hookpoint, CAST({seed} AS BIGINT) AS seed, * FROM ({_fit(f'label % 2 = {g}', _LARGEST)})"
    for g in (0, 1) for seed in q.FIT_SEEDS)

ORACLE["auxk_at_step"] = _SINCE + f""",
now AS (SELECT max(step) AS step FROM steps),
gone AS (SELECT d.latent_id FROM dict d LEFT JOIN (SELECT latent_id, max(cum) AS last FROM f JOIN cum USING (step), now
           WHERE step < now.step GROUP BY latent_id) l USING (latent_id),
         (SELECT max(cum) AS total FROM cum, now WHERE cum.step < now.step) t
         WHERE t.total - coalesce(l.last, 0) > {q.DEAD_LIST_THRESHOLD}),
par AS (SELECT count(*) AS n_dead, least(32, count(*)) AS k_aux, least(count(*) / 32.0, 1.0) AS scale FROM gone),
mine AS (SELECT err.* FROM err, now WHERE vec_id // {q.STEP_ROWS} = now.step),
acodes AS (SELECT vec_id, latent_id, act FROM (SELECT p.*, row_number() OVER (PARTITION BY vec_id ORDER BY act DESC, latent_id) AS r
           FROM pre p JOIN gone USING (latent_id)), par WHERE r <= par.k_aux),
ahat AS (SELECT c.vec_id, u.p, sum(c.act * u.w) + any_value(bdec.b[u.p]) AS eh
         FROM acodes c JOIN wdec u USING (latent_id), bdec GROUP BY c.vec_id, u.p),
tv AS (SELECT sum(v) AS v FROM (SELECT var_pop(y) * count(y) AS v FROM mine GROUP BY p)),
se AS (SELECT sum((a.eh - (e.y - e.h)) * (a.eh - (e.y - e.h))) AS s FROM mine e JOIN ahat a USING (vec_id, p))
SELECT now.step, CASE WHEN par.n_dead = 0 THEN 0.0 ELSE round(par.scale * se.s / tv.v, 6) END AS auxk,
       CAST(par.n_dead AS BIGINT) AS n_dead FROM now, par, tv, se"""
