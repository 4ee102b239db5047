"""Secret scan: fixed patterns, and sliding-window entropy of candidate strings.

Built-in functions only, one pass over the texts and no shuffle.

Method. Candidates are runs of at least ``WINDOW`` letters, digits and
``+/_=-``. A window of ``WINDOW`` characters slides over the candidate; the
counts of its characters are updated by the one that enters and the one that
leaves, and with them the sum of ``c * log2(c)``, from which its Shannon
entropy follows, and the counts of digits, small letters, capitals, hex digits
and separators. These make the window's class, which sets how random it must
be: hex digits, capitals with digits, small letters with digits, mixed case
with digits, or mixed case (anything else is words and is left alone). The
span runs from the first to the last window at or above its class's limit.
Words of the allow list (examples and placeholders, alphabets; one after the
other, in any case) are masked, and windows over a mask suppressed; UUIDs and digests named as such are as a whole.
Sums are whole numbers of millionths, so limits are met exactly.

Defined results: a null or empty text has no spans; a tie at the limit counts
as secret; repeated rows give repeated results; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.llm.spans import find, let, replace, spell

WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: A candidate may only start where a run starts, so a long run is read once.
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Classes of a window in their order: least entropy in bits, and the counts that make the class
#: (least number of hex digits, digits, small letters and capitals; most small letters, capitals and separators).
CLASSES = ((3.0, dict(hex=WINDOW, digit=1)),
           (3.3, dict(digit=1, upper=1, most_lower=0)),
           (3.75, dict(digit=3, lower=1, most_upper=0, most_other=1)),
           (3.8, dict(digit=1, lower=1, upper=1)),
           (3.9, dict(lower=7, upper=7, most_other=1)))
ALLOWED = ("example", "sample", "dummy", "placeholder", "changeme", "your_", "xxxx", "0123456789", "abcdefghij")
MASK = "~"
ALLOWED_WHOLE = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ALLOWED_BEFORE = r"(?i)(sha-?1|sha-?256|sha-?512|md5|digest|checksum|commit|uuid)\W{0,3}$"
SCALE = 1_000_000


def _weight(count: int) -> int:
    """``c * log2(c)`` in millionths."""
    return round(count * math.log2(count) * SCALE) if count else 0


def _limit(bits: float) -> int:
    """The largest sum of weights whose window has at least ``bits`` of entropy."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * SCALE)


def _members(at: Column) -> dict[str, Column]:
    """Which classes of characters the letter ``at`` in ALPHABET is in (none: a null or -1)."""
    return {"digit": at.between(0, 9), "lower": at.between(10, 35), "upper": at.between(36, 61),
            "other": at.between(62, len(ALPHABET) - 1), "masked": at == len(ALPHABET), "hex": at.between(0, 15) | at.between(36, 41)}


def _class_limit(a: Column) -> Column:
    """The largest sum of weights that a window of its class may have; null without a class."""
    def test(wanted):
        parts = [a[n[5:]] <= v if n.startswith("most_") else a[n] >= v for n, v in wanted.items()]
        out = parts[0]
        for x in parts[1:]:
            out = out & x
        return out
    return F.coalesce(*[F.when(test(wanted), F.lit(_limit(bits)).cast("bigint")) for bits, wanted in CLASSES])


def _hot_windows(hit: Column) -> Column:
    """(first, last) start of a window of ``hit`` that meets its class's limit
    and overlaps nothing allowed; nulls if none."""
    weights = F.array(*[F.lit(_weight(c)).cast("bigint") for c in range(WINDOW + 1)])
    kinds = ("digit", "lower", "upper", "other", "hex", "masked")
    zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0).cast("bigint").alias("sum"),
                    F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
                    *[F.lit(0).alias(k) for k in kinds])

    def run(codes, w):
        def moved(counts, enter, leave):
            return F.transform(counts, lambda c, i: c + F.when(i == enter, 1).otherwise(0) - F.when(i == leave, 1).otherwise(0))

        def step(a, at):
            enter, leave = codes[at], F.coalesce(F.get(codes, at - WINDOW), F.lit(-1))
            gone = F.when(leave >= 0, w[F.get(a["counts"], leave) - 1] - w[F.get(a["counts"], leave)]).otherwise(0)
            here = F.get(a["counts"], enter) - F.when(leave == enter, 1).otherwise(0)
            into, out = _members(enter), _members(leave)
            now = F.struct((a["sum"] + gone + w[here + 1] - w[here]).alias("sum"),
                           *[(a[k] + into[k].cast("int") - out[k].cast("int")).alias(k) for k in kinds])

            def kept(n):
                hot = (at >= WINDOW - 1) & (n["masked"] == 0) & F.coalesce(n["sum"] <= _class_limit(n), F.lit(False))
                return F.struct(
                    moved(a["counts"], enter, leave).alias("counts"), n["sum"].alias("sum"),
                    F.when(hot & a["first"].isNull(), at - WINDOW + 1).otherwise(a["first"]).alias("first"),
                    F.when(hot, at - WINDOW + 1).otherwise(a["last"]).alias("last"), *[n[k].alias(k) for k in kinds])
            return let(now, kept)

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step,
                           lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))

    for word in ALLOWED:
        hit = F.regexp_replace(hit, f"(?i){word}", MASK * len(word))
    codes = F.transform(F.split(hit, ""), lambda ch: F.instr(F.lit(ALPHABET + MASK), ch) - 1)
    return let(F.filter(codes, lambda x: x >= 0), lambda c: let(weights, lambda w: run(c, w)))


def _entropy_spans(text: Column) -> Column:
    def judged(place):
        before = F.substring(text, F.greatest(place["start"] - 15, F.lit(1)), F.least(place["start"], F.lit(16)))
        allowed = place["hit"].rlike(ALLOWED_WHOLE) | before.rlike(ALLOWED_BEFORE)
        # every class has a digit or a capital
        likely = place["hit"].rlike("[0-9A-Z]")
        return F.when(likely & ~allowed, let(_hot_windows(place["hit"]), lambda r: F.struct(
            (place["start"] + r["first"]).alias("start"), F.lit(3).alias("rank"),
            (place["start"] + r["last"] + WINDOW).alias("end"))))

    return F.filter(F.transform(find(text, CANDIDATE), judged), lambda s: s["start"].isNotNull())


def _ranked(places: Column, rank: int) -> Column:
    return F.transform(places, lambda p: F.struct(
        p["start"].alias("start"), F.lit(rank).alias("rank"), p["end"].alias("end")))


def scan(docs: DataFrame, text_col: str = "text", base: str = "_base", spans: str = "_spans") -> DataFrame:
    """``docs`` with two arrays of (kind, start, end) by start, then kind: the
    spans of the fixed patterns, and those together with the method's."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = F.array(*map(F.lit, KINDS))

    def named(xs):
        return F.transform(F.array_sort(xs), lambda s: F.struct(
            kinds[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    fixed = F.concat(_ranked(F.filter(find(text, ASSIGN, 2), lambda p: F.length(p["part"]) >= 6), 0),
                     _ranked(find(text, ACCESS), 1), _ranked(find(text, HEX), 2))
    more = let(_entropy_spans(text), lambda xs: xs)
    both = let(fixed, lambda f: let(more, lambda m: F.struct(
        named(f).alias("base"),
        named(F.concat(f, F.filter(m, lambda x: ~F.exists(
            f, lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"]))))).alias("spans"))))
    return (docs.withColumn("_secrets", both).withColumn(base, F.col("_secrets.base"))
            .withColumn(spans, F.col("_secrets.spans")).drop("_secrets"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``, and ``n_chars`` to match."""
    found = scan(docs).withColumn("text", replace(F.col("text"), F.col("_spans"), mark))
    return found.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast("bigint"))
                            .otherwise(F.col("n_chars"))).select(docs.columns)


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts by kind, a digest of the fixed patterns' spans, and all spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(spell(F.col("_base")), 256).alias("base_sha256"),
                        spell(F.col("_spans")).alias("spans"))


def _either_case(words) -> str:
    return "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words)


def oracle() -> str:
    """The query in DuckDB SQL: windows one by one, their characters counted anew."""
    assign = rf"""({_either_case(WORDS)})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    run = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"

    def kind(name, rank, pattern, keep):
        return f"""select r, doc_id, text, '{name}' kind, {rank} rank, unnest(list_transform(range(1, len(h) + 1), lambda i: {{
            'start': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0),
            'hit': h[i], 'part': g[i]}})) s from (select r, doc_id, text, regexp_extract_all(text, '{pattern}', 0) h,
            regexp_extract_all(text, '{pattern}', {keep}) g, string_split_regex(text, '{pattern}') p from d)"""

    sets = {"hex": "[0-9a-fA-F]", "digit": "[0-9]", "lower": "[a-z]", "upper": "[A-Z]", "other": "[+/_=-]"}

    def test(wanted):
        return " and ".join(f"n_{n[5:]} <= {v}" if n.startswith("most_") else f"n_{n} >= {v}" for n, v in wanted.items())

    masked = "hit"
    for word in ALLOWED:
        masked = f"regexp_replace({masked}, '(?i){word}', '{MASK * len(word)}', 'g')"
    bound = " ".join(f"when {test(wanted)} then {_limit(bits)}" for bits, wanted in CLASSES)
    numbers = ", ".join(f"len(regexp_extract_all(x, '{p}')) as n_{n}" for n, p in sets.items())
    return f"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') as text from documents),
fixed as (select r, doc_id, kind, rank, s.start::bigint a, s.start::bigint + length(s.hit) b from (
    select * from ({kind("assign", 0, assign, 2)}) where length(s.part) >= 6
    union all {kind("access", 1, ACCESS, 0)} union all {kind("hex", 2, HEX, 0)})),
judged as (select r, doc_id, s.start::bigint a, s.hit hit, text[greatest(s.start::bigint - 15, 1):s.start::bigint] before
    from ({kind("entropy", 3, run, 0)})),
cand as (select *, {masked} as seen from judged
    where regexp_matches(hit, '[0-9A-Z]') and not regexp_matches(hit, '{ALLOWED_WHOLE}')
      and not regexp_matches(before, '{ALLOWED_BEFORE}')),
wins as (select r, doc_id, a, unnest(range(0, length(hit) - {WINDOW} + 1)) w, seen from cand),
cut as (select r, doc_id, a, w, seen[w + 1:w + {WINDOW}] x from wins where not contains(seen[w + 1:w + {WINDOW}], '{MASK}')),
limits as (select r, doc_id, a, w, x, case {bound} end lim from (select *, {numbers} from cut)),
chars as (select r, doc_id, a, lim, w, unnest(string_split(x, '')) ch from limits where lim is not null),
sums as (select r, doc_id, a, lim, w, sum(round(n * log2(n) * {SCALE})::bigint) s
    from (select r, doc_id, a, lim, w, ch, count(*) n from chars group by all) group by all),
more as (select r, doc_id, 'entropy' kind, 3 rank, a + min(w) a, a + max(w) + {WINDOW} b from sums s0 where s <= lim group by r, doc_id, s0.a),
kept as (select * from more m where not exists (select 1 from fixed f where f.r = m.r and f.a <= m.a and f.b >= m.b)),
f as (select r, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access,
    count(*) filter (kind = 'hex') n_hex, string_agg(kind || ':' || a || ':' || b, ',' order by a, rank, b) base from fixed group by r),
s as (select r, string_agg(kind || ':' || a || ':' || b, ',' order by a, rank, b) spans
    from (select * from fixed union all select * from kept) group by r)
select doc_id, coalesce(n_assign, 0)::bigint n_assign, coalesce(n_access, 0)::bigint n_access, coalesce(n_hex, 0)::bigint n_hex,
    sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from d left join f using (r) left join s using (r)"""
