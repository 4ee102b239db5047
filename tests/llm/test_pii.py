import math
import re

from llm_helpers import sentence
from pyspark.sql import functions as F

from tessera.llm import pii, spans


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def base(text):
    t, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def spell(xs):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in xs)


def test_base_equals_brute_force(spark, documents, rng):
    texts = [None, "", "a@b.c%x@d.e.%f@g.h", "@a.b a@ a@b a@b. a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1..2.3.4", "4" * 5000,
             "4111 1111 1111 1111 x4111-1111-1111-1111", "4111  1111 1111 1111", "+1 (555) 123-4567. +123 +12345678 +1234567(((", "7" * 16,
             "é a.b@c-d.org é +44 20 7946 0958 ü", "x" * 60000, "1." * 3000, "a@b" + ".c" * 6000, sentence(rng, 5000) + " q@r.st"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a@b.com", " ", "+1", "23", "4.5", ".", "-", "(555)", "4111 1111 1111 1111", "é", "@", "%", "\n", "0"])
                             for _ in range(rng.randrange(1, 14))))
    got = pii.candidates(documents(texts)).select("doc_id", F.array_sort(F.transform("_fixed", lambda s: F.struct(
        s["rank"].alias("k"), s["start"].alias("a"), s["end"].alias("b")))).alias("f")).collect()
    for r in got:
        assert [(x.k, x.a, x.b) for x in r.f] == base(texts[r.doc_id]), texts[r.doc_id][:200]


def test_method_adds_likely_spans_and_only_those(spark, documents):
    plain = [f"Anna Thble order {i} of the year 2019-2020 and {i}{i + 1} pages, part 12 34 56 78 {i:02}" for i in range(20)]
    likely = [f"phone: (555) 123-45{i:02} contact John Smith, mail bob{i} [at] mail.example.com" for i in range(20)]
    fixed = [f"call +1 555 123 45{i:02} or a{i}@example.com" for i in range(20)]
    got = {r.doc_id: r.s for r in pii.scan(documents(plain + likely + fixed)).select("doc_id", spans.spell(F.col("_spans")).alias("s")).collect()}
    assert all(got[i] == "" for i in range(20)), got[0]
    for i in range(20, 40):
        text = likely[i - 20]
        kinds = dict((k, text[int(a):int(b)]) for k, a, b in (x.split(":") for x in got[i].split(",")))
        assert kinds["number"].endswith(f"123-45{i - 20:02}") and kinds["mail"].startswith("bob") and kinds["name"] == "John Smith"
    assert all(got[i].startswith("email:") and "phone:" in got[i] for i in range(40, 60))


def test_em_tells_reliable_labelers_from_noise():
    counts = []
    for code in range(3 ** 5):
        votes = [code // 3 ** (4 - j) % 3 - 1 for j in range(5)]
        if 0 in votes:
            continue
        # labelers 0-2 are right nine times in ten, 3 and 4 guess
        n = sum(0.5 * math.prod(0.9 if votes[j] == y else 0.1 for j in range(3)) * 0.25 for y in (1, -1))
        counts.append((0, code, pii.feature(0, 0, 0, 0), round(100000 * n)))
    right, share, _ = pii.reliabilities(counts)
    assert all(abs(r - 0.9) < 0.02 for r in right[:3]) and all(r < 0.55 for r in right[3:]) and abs(share[0] - 0.5) < 0.05


def test_empty_and_redact(spark, documents):
    assert pii.scan(documents([])).count() == 0
    docs = documents(["write to a.b@c.org or +1 555 123 4567!", None, "plain"])
    assert pii.redact(docs).columns == docs.columns
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()} == {0: "write to [PERSONAL] or [PERSONAL]!", 1: None, 2: "plain"}


def test_query_runs_whole(spark):
    from llm_helpers import SF_SMALL
    rows = pii.op9_personal(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert spell(want) == ",".join(s for s in r.spans.split(",") if s.split(":")[0] in pii.KINDS[:4])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for k, _, _ in want) for j in range(4))
