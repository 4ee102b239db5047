"""Personal data by weak supervision.

Built-in functions only; the texts are read once and nothing is shuffled but
counts.

Method. Candidates are the spans of the fixed patterns (email, ip, card,
phone) and of three wider ones: spelled-out mail addresses, grouped numbers,
and capitalised words after a given name. Five labelers vote on each (for,
against, or nothing): shape of the span, gazetteers (domain endings, issuers,
calling codes, names), words before it, signs after it, and its digits. The
corpus is then reduced to counts by kind, votes and span features, a table
whose size is bounded by the number of such combinations. On it, expectation
maximisation estimates how reliable each labeler is and how common each kind
is, and a logistic span classifier is trained on the resulting
probabilities. A candidate outside the fixed patterns becomes a span when
enough labelers speak for it (for a name, a word before it must), the
classifier gives it ``ACCEPT`` or more and no fixed span overlaps it. Fixed spans always stay.

Defined results: null and empty texts have no spans; a tie at ``ACCEPT``
accepts; without candidates nothing is fitted and nothing added; repeated
rows vote as often as they occur; extra columns are ignored; an empty table
gives no rows. Patterns are written so that a text's length costs linear time
(runs are entered only at their start, loops don't give back).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, table
from tessera.llm.spans import find, let, replace, spell

KINDS = ("email", "ip", "card", "phone", "mail", "number", "name")
FIXED = 4
ACCEPT = 0.8
#: Labelers that must speak for a candidate, on balance: its own pattern makes a name's gazetteer vote certain.
LEAST_VOTES = {"mail": 1, "number": 1, "name": 2}

_LOCAL = r"[A-Za-z0-9._%+-]"
GIVEN_NAMES = ("Alice|Anna|Anne|Carlos|Carmen|Charles|Claire|Daniel|David|Elena|Emma|Eric|Eva|Frank|George|Hans|Helen|Henry|"
               "Ines|Isabel|Jack|Jacques|James|Jane|Jean|Joan|John|Jorge|Jose|Juan|Julia|Karl|Klaus|Laura|Linda|Louis|Lucia|"
               "Luis|Marc|Maria|Marie|Martin|Mary|Michael|Miguel|Monica|Nina|Paul|Peter|Pierre|Robert|Rosa|Sarah|Sofia|"
               "Susan|Thomas|Walter|William")
#: As the query's contract gives them, but entered at the start of a run only and without backtracking.
PATTERNS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]+)++",
    r"(?<![0-9A-Za-z.+])[(]?[0-9](?:[().\x20/-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z])",
    rf"(?<![A-Za-z])(?:{GIVEN_NAMES})\x20[A-Z][a-z]+(?![A-Za-z])",
)
ENDINGS = "com|org|net|edu|gov|info|eu|de|fr|es|uk|at|ch|us|ca|it|mx|ar"
_PERSON = r"(?i)(mail|contact|phone|tel|call|mobile|fax|ssn|social|card|visa|account|iban|address|name|mr|mrs|dr)[a-z]{0,3}[ .:=#]{0,3}$"
_THING = r"(?i)(version|isbn|issn|doi|page|chapter|figure|table|order|invoice|section|price|part|model|year|no)[a-z]{0,3}[ .:=#]{0,3}$"
#: labeler -> what it reads -> by kind: patterns for and against
LABELERS = (
    ("hit", ((rf"\.[A-Za-z]{{2,6}}$", r"\.[0-9]+$"), (r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", None), (r"^[3-6]", r"^0"),
             (r"^\+[1-9]", r"\.\.|--|  "), (r"(\.|[(\[]dot[)\]])\x20?[A-Za-z]{2,6}$", None),
             (r"^\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
              r"^[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}$|^[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}$|^[12][0-9]{3}\x20?-\x20?[12][0-9]{3}$"),
             (None, None))),
    ("hit", ((rf"\.({ENDINGS})$", r"(?i)^(noreply|no-reply|info|support)@"), (None, r"^(0|10|127|192\.168|255)\."),
             (r"^(4|5[1-5]|34|37|6011)", None), (r"^\+(1|3[0-4]|39|4[0134]|49|52|54|55|61|7|81|86|91)", None),
             (rf"\x20?({ENDINGS})$", None), (None, None), (rf"^({GIVEN_NAMES})\x20", None))),
    ("before", ((_PERSON, _THING),) * 7),
    ("after", ((None, None), (None, r"^/[0-9]{1,2}"), (None, r"^\x20?(%|€|\$|km|kg|px)"), (None, None), (None, None),
               (None, r"^\x20?(%|€|\$|km|kg|px|EUR|USD)"), (None, r"^\x20(Street|Avenue|University|Company|Inc)"))),
    ("digits", ((None, None), (None, None), (r"^[0-9]{15,16}$", None), (r"^[0-9]{10,13}$", None), (None, None),
                (r"^[0-9]{9,11}$", r"^[0-9]{1,7}$"), (None, None))),
)


def _luhn(digits: Column) -> Column:
    def worth(ch, i, n):
        d = ch.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 0, twice).otherwise(d)

    return let(F.filter(F.split(digits, ""), lambda c: c != ""), lambda cs: F.aggregate(
        F.transform(cs, lambda c, i: worth(c, i, F.size(cs))), F.lit(0), lambda a, x: a + x) % 10 == 0)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _holds(kind: str, place: Column) -> Column:
    """The check that a fixed pattern's match must pass."""
    if kind == "ip":
        return place["hit"].rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        # only 13 to 19 digits reach the checksum
        return let(_digits(place["hit"]), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(place["hit"])).between(9, 15)
    return F.lit(True)


def _judged(text: Column, rank: int, place: Column) -> Column:
    """(start, end, votes, feature) of a candidate; votes in base three, feature as :func:`features` gives it."""
    reads = {"hit": place["hit"], "digits": _digits(place["hit"]),
             "before": F.substring(text, F.greatest(place["start"] - 23, F.lit(1)), F.least(place["start"], F.lit(24))),
             "after": F.substring(text, place["end"] + 1, F.lit(12))}
    votes = []
    for what, by_kind in LABELERS:
        yes, no = by_kind[rank]
        v = F.lit(0)
        if no:
            v = F.when(reads[what].rlike(no), -1).otherwise(v)
        if yes:
            v = F.when(reads[what].rlike(yes), 1).otherwise(v)
        votes.append(v)
    count = F.length(reads["digits"])
    size = F.when(count == 0, 0).when(count <= 6, 1).when(count <= 8, 2).when(count <= 12, 3).otherwise(4)
    parted = F.when(place["hit"].rlike(r"[0-9][ ().-]+[0-9]"), 1).otherwise(0)
    return let(F.array(*votes), lambda vs: F.struct(
        place["start"].alias("start"), place["end"].alias("end"), F.lit(rank).alias("rank"),
        F.aggregate(vs, F.lit(0), lambda a, v: a * 3 + v + 1).alias("votes"),
        feature(F.lit(rank), size, parted, F.greatest(F.lit(-2), F.least(F.lit(2), F.aggregate(
            vs, F.lit(0), lambda a, v: a + v)))).alias("feature")))


def feature(rank, size, parted, total):
    return ((rank * 5 + size) * 2 + parted) * 5 + total + 2


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_fixed`` and ``_other``: the judged candidates of the
    fixed patterns and of the wider ones (those that overlap no fixed span)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    def judged(k):
        places = find(text, PATTERNS[k])
        if k < FIXED:
            places = F.filter(places, lambda p: _holds(KINDS[k], p))
        return F.transform(places, lambda p: _judged(text, k, p))

    fixed = F.concat(*map(judged, range(FIXED)))
    other = F.concat(*map(judged, range(FIXED, len(KINDS))))
    both = let(fixed, lambda f: let(other, lambda o: F.struct(f.alias("fixed"), F.filter(o, lambda x: ~F.exists(
        f, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))).alias("other"))))
    return (docs.withColumn("_found", both).withColumn("_fixed", F.col("_found.fixed"))
            .withColumn("_other", F.col("_found.other")).drop("_found"))


def reliabilities(counts: list[tuple[int, int, int, int]], rounds: int = 60) -> tuple[list[float], list[float], dict]:
    """Expectation maximisation on (rank, votes, feature, n): how often each
    labeler's vote is right, how common personal data is among each kind's
    candidates, and the probability of each (rank, votes)."""
    right, share = [0.8] * len(LABELERS), [0.5] * len(KINDS)
    table_: dict[tuple[int, int], int] = {}
    for rank, votes, _, n in counts:
        table_[rank, votes] = table_.get((rank, votes), 0) + n

    def votes_of(code):
        return [code // 3 ** (len(LABELERS) - 1 - j) % 3 - 1 for j in range(len(LABELERS))]

    posterior: dict[tuple[int, int], float] = {}
    for _ in range(rounds):
        for (rank, code) in sorted(table_):
            yes, no = share[rank], 1 - share[rank]
            for v, a in zip(votes_of(code), right):
                if v:
                    yes *= a if v > 0 else 1 - a
                    no *= 1 - a if v > 0 else a
            posterior[rank, code] = yes / (yes + no)
        good, cast = [4.0] * len(right), [5.0] * len(right)
        mass, all_ = [2.0] * len(share), [4.0] * len(share)
        for (rank, code), n in sorted(table_.items()):
            p = posterior[rank, code]
            mass[rank] += n * p
            all_[rank] += n
            for j, v in enumerate(votes_of(code)):
                if v:
                    good[j] += n * (p if v > 0 else 1 - p)
                    cast[j] += n
        right = [min(max(g / c, 0.5), 0.99) for g, c in zip(good, cast)]
        share = [m / a for m, a in zip(mass, all_)]
    return right, share, posterior


def _inputs(code: int) -> list[float]:
    total, rest = code % 5 - 2, code // 5
    parted, rest = rest % 2, rest // 2
    size, rank = rest % 5, rest // 5
    return [float(rank == k) for k in range(len(KINDS))] + [float(size == k) for k in range(5)] + [float(parted), float(total)]


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Gauss-Jordan elimination of a small positive definite system."""
    n, m = len(b), [[*row, x] for row, x in zip(a, b)]
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        m[i] = [x / m[i][i] for x in m[i]]
        for r in range(n):
            if r != i and m[r][i]:
                m[r] = [x - m[r][i] * y for x, y in zip(m[r], m[i])]
    return [row[-1] for row in m]


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def classifier(counts: list[tuple[int, int, int, int]], ridge: float = 0.1, rounds: int = 25) -> list[float]:
    """Weights of a logistic classifier of span features, by Newton's method
    on the aggregated table with the probabilities of :func:`reliabilities`."""
    _, _, posterior = reliabilities(counts)
    mass: dict[int, list[float]] = {}
    for rank, votes, code, n in sorted(counts):
        m = mass.setdefault(code, [0.0, 0.0])
        m[0] += n
        m[1] += n * posterior[rank, votes]
    rows = [(_inputs(code), n, p) for code, (n, p) in sorted(mass.items())]
    size = len(_inputs(0))
    w = [0.0] * size
    for _ in range(rounds):
        hess = [[ridge * (i == j) for j in range(size)] for i in range(size)]
        grad = [-ridge * x for x in w]
        for x, n, p in rows:
            q = _sigmoid(sum(a * b for a, b in zip(w, x)))
            used = [i for i in range(size) if x[i]]
            for i in used:
                grad[i] += x[i] * (p - n * q)
                for j in used:
                    hess[i][j] += n * max(q * (1 - q), 1e-6) * x[i] * x[j]
        step = _solve(hess, grad)
        w = [a + b for a, b in zip(w, step)]
    return w


def accepted(weights: list[float]) -> list[int]:
    """Features of candidates that become spans: all are listed, there are few."""
    return [code for code in range(feature(FIXED, 0, 0, -2), feature(len(KINDS), 0, 0, -2))
            if code % 5 - 2 >= LEAST_VOTES[KINDS[code // 50]] and _sigmoid(sum(a * b for a, b in zip(weights, _inputs(code)))) >= ACCEPT]


def fit(found: DataFrame) -> list[int]:
    """The accepted features, learned from all candidates of ``found``. What
    comes to the driver is one row for each combination of kind, votes and
    feature that occurs (at most 7 * 3^5 * 50)."""
    rows = (found.select(F.inline(F.concat("_fixed", "_other"))).groupBy("rank", "votes", "feature").count().collect())
    counts = [(r["rank"], r["votes"], r["feature"], r["count"]) for r in rows]
    return accepted(classifier(counts)) if counts else []


def scan(docs: DataFrame, text_col: str = "text", keep: list | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) with two arrays of (kind,
    start, end) by kind, then start: ``_base`` of the fixed patterns,
    ``_spans`` with the method's."""
    columns = docs.columns if keep is None else keep
    found = materialise(candidates(docs, text_col).select(*columns, "_fixed", "_other"), "personal")
    good = fit(found)
    kinds = F.array(*map(F.lit, KINDS))

    def named(xs):
        return F.transform(F.array_sort(F.transform(xs, lambda s: F.struct(
            s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))), lambda s: F.struct(
                kinds[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    more = F.filter("_other", lambda x: x["feature"].isin(good)) if good else F.slice("_other", 1, 0)
    return (found.withColumn("_base", named(F.col("_fixed"))).withColumn("_spans", named(F.concat("_fixed", more)))
            .drop("_fixed", "_other"))


def redact(docs: DataFrame, mark: str = "[PERSONAL]") -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by ``mark``."""
    found = scan(docs).withColumn("text", replace(F.col("text"), F.array_sort(F.transform(
        "_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))), mark))
    return found.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast("bigint"))
                            .otherwise(F.col("n_chars"))).select(docs.columns)


def op9_personal(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts by kind, a digest of the fixed patterns' spans, and all spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def count(kind):
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS[:FIXED]],
                        F.sha2(spell(F.col("_base")), 256).alias("base_sha256"), spell(F.col("_spans")).alias("spans"))
