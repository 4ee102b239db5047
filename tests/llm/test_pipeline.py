import hashlib
import re
from collections import defaultdict

import corpus_pipeline
from llm_helpers import SF_SMALL, sentence
from test_bpe import LIBRARY, expect
from test_decontamination import brute as leaks
from test_quality import brute_repeats
from test_secrets import base, entropy
from test_simhash import brute_components, brute_fp

from tessera.llm import quality


def normal(line):
    low = line.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"))
    return " ".join(w.decode() for w in low.encode().split())


def clean_quality(docs, limit=quality.LIMIT):
    """Rows (id, text, source) after the first stage."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    key = lambda s: md5(s)[:16]
    own, texts = [], defaultdict(set)
    for _, text, source in docs:
        own.append({key(normal(x)): normal(x).split() for x in (text or "").split("\n") if normal(x)})
        for k in own[-1]:
            texts[source, k].add(text)
    known = defaultdict(lambda: (set(), set()))
    for (_, text, source), lines in zip(docs, own):
        mine = [min(md5(" ".join(ws[i:i + 3]))[:15] for i in range(max(len(ws) - 2, 1))) for k, ws in lines.items()
                if len(texts[source, k]) <= limit]
        most = [max(md5(" ".join(ws[i:i + 3]))[:15] for i in range(max(len(ws) - 2, 1))) for k, ws in lines.items()
                if len(texts[source, k]) <= limit]
        for k in lines:
            rest = sorted(set(lines) - {k}) or [md5(text)[:15]]
            known[source, k][0].add(min(mine) if mine else rest[0])
            known[source, k][1].add(max(most) if most else rest[-1])
    common = {k for k, (low, high) in known.items() if len(texts[k]) > limit and (m := max(len(low), len(high))) > limit
              and 2 * m >= len(texts[k])}
    out = []
    for n, (i, text, source) in enumerate(docs):
        words = (text or "").encode().split()
        gone = {x for x in own[n] if (source, x) in common}
        left = [x for x in (text or "").split("\n") if not normal(x) or key(normal(x)) not in gone]
        kept = len(" ".join(left).encode().split())
        if len(words) >= 10 and 100 * brute_repeats(words) <= 20 * len(words) and kept >= max(quality.LEFT_WORDS, quality.LEFT_SHARE * len(words)):
            out.append((i, "\n".join(left) if gone else text, source))
    return out


def brute(docs, items):
    docs = clean_quality(docs)
    fps = [brute_fp(t) for _, t, _ in docs]
    docs = [d for d, c in zip(docs, brute_components([d[0] for d in docs], fps)) if d[0] == c]
    hit = {a for a, _, _ in leaks([t for _, t, _ in docs], items)}
    out = {}
    for n, (i, text, _) in enumerate(docs):
        if n in hit:
            continue
        fixed = base(text)
        spans = sorted((a, b) for a, _, b in fixed + [x for x in entropy(text) if not any(a <= x[0] and b >= x[2] for a, _, b in fixed)])
        at, pieces = 0, []
        for a, b in spans:
            if a >= at:
                pieces.append(text[at:a] + "[SECRET]")
            at = max(at, b)
        text = "".join(pieces) + text[at:]
        ids = expect([text])[0]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[i] = (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
    return out


def test_pipeline_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == brute(docs, items) and len(got) > 100


def test_planted_cases_on_a_small_table(spark, documents, rng, tmp_path):
    benchmark = [(1, sentence(rng, 20)), (2, sentence(rng, 30))]
    own = [sentence(rng, 40) for _ in range(30)]
    banner = "All rights reserved by the example company, see terms"
    texts = own + [f"{sentence(rng, 30)}\n{banner}" for _ in range(30)]  # clean, with a common line
    texts += [own[0], own[1] + " extra", "too short", None, "", "word " * 50, "a b c d e f " * 20]
    texts += [sentence(rng, 30) + " " + benchmark[0][1].upper() + "! " + sentence(rng, 9), sentence(rng, 40) + " password=abcdef123456 " + sentence(rng, 5)]
    docs = documents(texts)
    names = [f.name for f in docs.schema.fields]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == names, name
    left = {r.doc_id: r.text for r in step.collect()}
    assert set(range(60)) <= set(left) and not any(banner in t for t in left.values())
    assert not {60, 62, 63, 64, 65, 66, 67} & set(left)
    assert re.search(r" \[SECRET\] ", left[68])
    got = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == brute(list(zip(range(len(texts)), texts, ["src0"] * len(texts))), benchmark)
    step.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(f"{tmp_path}/empty/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
