"""Quality rules: per-document word rules and cross-document line frequency.

Method. A line is normalised (A-Z lowered, digits as 0, white space runs as
one space) and hashed. Per host (the ``source`` column) the distinct
documents that hold a line are counted; equal texts are one document. A line
is above its limit when it stands among more than ``limit`` different
documents of the host, whatever the host's size. Different
means different elsewhere: lines that stand among more than ``limit`` texts are
candidates, and a document is known by the smallest and the largest hash of
``SHINGLE`` words of its other lines. So boilerplate of many lines doesn't hide
itself, and copies of one document (exact, or with some words changed) are
known alike and left to the near-duplicate operator. A document of candidates
alone is known by its smallest and largest other line, one of a single line by
its text. At least half of the documents that hold the line must differ so.
Lines above their limit are removed, and a document that has less than
``LEFT_SHARE`` of its words or fewer than ``LEFT_WORDS`` left is depleted and
rejected.

Texts are read once: word rules and line hashes of each document go to a
scratch table, counts and joins run on hashes. Counts are summed before the
shuffle, and the joins of documents with candidates and with removed lines are
salted, as one line may stand in a third of all documents.

Defined results: a null text is empty and fails the word rules; a null host is
a host of its own; a document at exactly a limit is kept; repeated rows are
judged one by one; an empty table gives no rows; extra columns pass through
``clean`` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, table

MIN_WORDS = 10
REPEAT_PERCENT = 20
LIMIT = 20
SHINGLE = 3
LEFT_SHARE = 0.3
LEFT_WORDS = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_SALTS = 16


def repeated_words(words: list, window: int = 5) -> int:
    """Words inside windows of five words that the text has twice or more."""
    if len(words) <= window:
        return 0
    codes: dict = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    names, size = ids, 1
    while size < window:  # name longer and longer runs by whole numbers
        _, names = np.unique(names[:-1] * len(codes) + ids[size:], return_inverse=True)
        size += 1
        if names.max() + 1 == len(names):
            return 0
    again = np.bincount(names)[names] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(again)] += again
    edge[window:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """Hash of a normalised line."""
    return int.from_bytes(hashlib.md5(b" ".join(words)).digest()[:8], "big")


def shingle_ends(words: list[bytes]) -> tuple[int, int]:
    """The smallest and the largest hash of SHINGLE words in a row (of the whole line if it has fewer)."""
    runs = zip(*(words[i:] for i in range(SHINGLE))) if len(words) > SHINGLE else [words]
    hashes = [md5(b" ".join(r)).digest() for r in runs]
    return _number(min(hashes)), _number(max(hashes))


def _number(digest: bytes) -> int:
    """The first 60 bits of a digest."""
    return int.from_bytes(digest[:8], "big") >> 4


def _measure(text: str | None) -> tuple:
    t = text or ""
    raw = t.encode()
    words = raw.split()
    worded = [x for x in raw.split(b"\n") if x.split()]
    total: dict[int, int] = {}
    ends: dict[int, tuple[int, int]] = {}
    for x in worded:
        line = x.translate(_NORMAL).split()
        h = line_hash(line)
        total[h] = total.get(h, 0) + len(line)
        if h not in ends:
            ends[h] = shingle_ends(line)
    order = sorted(total)
    return (len(words), len(t) - sum(map(t.count, SPACES)), sum(map(t.count, SYMBOLS)), len(worded) - len(set(worded)),
            repeated_words(words), hashlib.md5(raw).hexdigest(),
            np.array(order, np.uint64).view(np.int64), np.array([total[h] for h in order], np.int64),
            *(np.array([ends[h][i] for h in order], np.uint64).view(np.int64) for i in (0, 1)))


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "digest", "line", "words", "first", "last")


def measure(docs: DataFrame) -> DataFrame:
    """The word rules' numbers and the sorted line hashes of each document of
    ``docs`` (columns name, host, text; name and host strings)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [_measure(t) for t in b["text"]]
            yield pd.DataFrame({"name": b["name"], "host": b["host"],
                                **{f: [r[i] for r in rows] for i, f in enumerate(_FIELDS)}})

    return docs.select("name", "host", "text").mapInPandas(
        run, "name string, host string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, digest string, line array<bigint>, words array<bigint>, first array<bigint>, last array<bigint>")


def _salted(common: DataFrame) -> DataFrame:
    return common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))


def _salt() -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int").alias("salt")


def held_candidates(measured: DataFrame, texts: DataFrame) -> DataFrame:
    """(name, row, host, line, words, low, high): the candidates (``texts``: host, line) that each row of
    ``measured`` holds, with what the document is known by."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for name, row, host, digest, line, words, first, last, found in zip(*(b[c] for c in b.columns)):
                is_in = np.isin(line, found)
                at = np.flatnonzero(is_in)
                own = ~is_in
                if own.any():
                    low, high = np.full(len(at), first[own].min()), np.full(len(at), last[own].max())
                elif len(line) > 1:  # lines are sorted
                    low, high = np.where(at == 0, line[1], line[0]), np.where(at == len(line) - 1, line[-2], line[-1])
                else:
                    low = high = np.array([int(digest[:15], 16)])
                for x, y in zip(out, ([name] * len(at), [row] * len(at), [host] * len(at), line[at], words[at], low, high)):
                    x.extend(y)
            yield pd.DataFrame(dict(zip(("name", "row", "host", "line", "words", "low", "high"), out)))

    # a document's candidates are at most its own lines
    found = (measured.select("row", "host", _salt(), F.explode("line").alias("line"))
             .join(_salted(texts.select("host", "line")), ["host", "line", "salt"], "left_semi")
             .groupBy("row").agg(F.collect_list("line").alias("found")))
    return measured.join(found, "row").select("name", "row", "host", "digest", "line", "words", "first", "last", "found").mapInPandas(
        run, "name string, row bigint, host string, line bigint, words bigint, low bigint, high bigint")


def common_lines(held: DataFrame, texts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(host, line) above the limit. ``held``: see :func:`held_candidates`; ``texts``: host, line, texts."""
    ways = []
    for side in ("low", "high"):
        # two steps, so that a line of very many documents is summed by parts
        one = held.groupBy("host", "line", side).agg(F.lit(1).alias("x"))
        ways.append(one.groupBy("host", "line").agg(F.count(F.lit(1)).alias(f"n_{side}")))
    return (texts.join(ways[0], ["host", "line"]).join(ways[1], ["host", "line"])
            .withColumn("n", F.greatest("n_low", "n_high"))
            .where((F.col("n") > limit) & (2 * F.col("n") >= F.col("texts")))
            .select("host", "line"))


def judge(docs: DataFrame, name_col: str = "doc_id", host_col: str = "source", limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """The verdict on each row of ``docs`` (``name``: its ``name_col`` as a
    string; the word rules' numbers, ``n_removed_words``, ``base_failed``,
    ``kept``), and the removed lines as (name, row, line)."""
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    told = docs.select(F.col(name_col).cast("string").alias("name"), host.alias("host"), F.col("text").alias("text"))
    # names may repeat; the row numbers are fixed by being written
    measured = materialise(measure(told).withColumn("row", F.monotonically_increasing_id()), "quality")
    texts = materialise(
        measured.select("host", F.xxhash64("digest").alias("digest"), F.explode("line").alias("line")).distinct()
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") > limit), "quality-texts")
    held = materialise(held_candidates(measured, texts), "quality-candidates")
    removed = held.withColumn("salt", _salt()).join(
        _salted(common_lines(held, texts, limit)), ["host", "line", "salt"], "left_semi").select(
        "name", "row", "line", "words")
    lost = removed.groupBy("row").agg(F.sum("words").alias("lost"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    verdict = (measured.join(lost, "row", "left").withColumn("n_removed_words", F.coalesce("lost", F.lit(0).cast("bigint")))
               .withColumn("base_failed", failed)
               .withColumn("kept", ~failed & (left >= LEFT_WORDS) & (left >= LEFT_SHARE * F.col("n_words"))))
    return verdict.drop("lost", "line", "words", "first", "last", "digest", "host"), removed.drop("words")


def clean(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The kept documents of ``docs`` without the lines above their limit
    (``n_chars`` follows), with all columns."""
    numbered = materialise(docs.withColumn("_name", F.monotonically_increasing_id()), "quality-documents")
    verdict, removed = judge(numbered, "_name", limit=limit)
    # a document's removed lines are at most its own lines
    gone = removed.groupBy("name").agg(F.collect_set(F.lower(F.lpad(F.hex("line"), 16, "0"))).alias("_gone"))
    kept = (verdict.where("kept").select("name").join(gone, "name", "left")
            .select(F.col("name").cast("bigint").alias("_name"), "_gone"))

    def stays(line, gone_):
        plain = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
        plain = F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))
        return (plain == "") | ~F.array_contains(gone_, F.substring(F.md5(plain), 1, 16))

    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter(F.split("text", "\n"), lambda x: stays(x, F.col("_gone"))), "\n"))
    return (numbered.join(kept, "_name").withColumn("text", text)
            .withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(
                F.length("text").cast("bigint"))).select(docs.columns))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Word rules and cross-document line frequency over all documents."""
    docs = table(spark, sf_dir, "documents")
    verdict, _ = judge(docs)
    return verdict.select(F.col("name").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_words", "word_chars",
                          "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def oracle() -> str:
    """The query in DuckDB SQL, on the lines themselves."""
    word = r"[^\x20\x09-\x0D]+"
    return f"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') as t, coalesce('=' || source, '') host from documents),
w as (select *, regexp_extract_all(t, '{word}') w from d),
grams as (select r, i, array_to_string(w[i:i + 4], ' ') g from (select r, w, unnest(range(1, len(w) - 3)) i from w)),
twice as (select r, i, count(*) over (partition by r, g) n from grams),
repeats as (select r, count(distinct j) n from (select r, unnest(range(i, i + 5)) j from twice where n > 1) group by r),
l as (select r, host, t, unnest(string_split(t, chr(10))) raw from d),
worded as (select *, array_to_string(ws, ' ') as norm, substr(md5(array_to_string(ws, ' ')), 1, 16) as line, len(ws) as words
    from (select r, host, t, raw, list_transform(regexp_extract_all(raw, '{word}'), lambda x: translate(x,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')) as ws from l where regexp_matches(raw, '{word}'))),
dups as (select r, count(*) - count(distinct raw) n from worded group by r),
own as (select r, host, any_value(md5(t)) digest, line, sum(words) words, any_value(ws) ws from worded group by r, host, line),
runs as (select *, list_transform(range(1, greatest(len(ws) - {SHINGLE - 1}, 1) + 1), lambda i:
    substr(md5(array_to_string(ws[i:i + {SHINGLE - 1}], ' ')), 1, 15)) as h from own),
texts as (select host, line, count(distinct digest) texts from own group by host, line having count(distinct digest) > {LIMIT}),
marked as (select o.*, list_min(h) first, list_max(h) last, t.texts is not null candidate, t.texts
    from runs o left join texts t on t.host = o.host and t.line = o.line),
known as (select *, min(first) filter (not candidate) over (partition by r) low_own,
    max(last) filter (not candidate) over (partition by r) high_own,
    count(*) over (partition by r) n_lines, min(line) over (partition by r) l1, max(line) over (partition by r) h1 from marked),
others as (select r, min(line) filter (line <> l1) l2, max(line) filter (line <> h1) h2 from known group by r),
seen as (select k.*, case when low_own is not null then low_own when n_lines = 1 then substr(digest, 1, 15)
      when line = l1 then l2 else l1 end low,
    case when high_own is not null then high_own when n_lines = 1 then substr(digest, 1, 15)
      when line = h1 then h2 else h1 end high
    from known k join others using (r) where candidate),
common as (select host, line from seen group by host, line, texts
    having greatest(count(distinct low), count(distinct high)) > {LIMIT}
    and 2 * greatest(count(distinct low), count(distinct high)) >= texts),
gone as (select r, sum(words)::bigint n from seen join common using (host, line) group by r),
m as (select r, doc_id, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols, coalesce(dups.n, 0)::bigint n_dup_lines,
    coalesce(repeats.n, 0)::bigint n_repeat_words, coalesce(gone.n, 0)::bigint n_removed_words
    from w left join dups using (r) left join repeats using (r) left join gone using (r)),
v as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and n_words - n_removed_words >= {LEFT_WORDS} and n_words - n_removed_words >= {LEFT_SHARE} * n_words as kept,
    n_removed_words from v"""
