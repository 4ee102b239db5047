"""Phrase collocations by direct-address tiling.

Words that occur ``LEAST`` times are ranked by frequency and known by their
rank from then on. The grid of all (word, word) pairs is cut into square tiles
of ``TILE`` ranks; frequent words meet in a few tiles near the corner. A block
of text counts its pairs tile by tile: a tile that many of the block's pairs
fall into is a dense array addressed by the pair's cell (one ``bincount``),
all other tiles keep sorted coordinates with counts. Counts of the blocks meet
in buckets, where sorted coordinates are merged. Pairs that occur ``LEAST``
times are ranked in turn and the same step, run on (pair, word), counts phrases
of three words: such a phrase can only be frequent if both its pairs are.

Work moves as arrays: a block of ``BLOCK`` bytes sends each bucket one row with
the block's different words (or pairs) of that bucket and their counts, and
gets back one row with the ranks of the frequent ones. Buckets are chosen by
hash, so many that each meets about ``BUCKET`` bytes of text; a key that is in
every block is one entry a block. A rank is the place by frequency inside a
bucket, times the number of buckets, plus the bucket: unique, and in order of
frequency but for chance. Nothing of the vocabulary's size is broadcast or
collected; the frequent phrases' words and counts are looked up by salted
joins, as a frequent word is in many of them. Counts are exact and products of
counts are decimals of 38 digits (counts below 10^15).

Results in special cases: a null language is ``und``, like that name itself; a
null or empty text has no words; a piece never runs over a text's end; texts of
any length count whole; repeated rows count as often as they occur; ties are
ranked by phrase; a table without a frequent phrase gives no rows. Only the
columns lang and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, table, text_blocks

LEAST = 10
TOP = 2000
COVER = 50  # a phrase goes if a longer one has this many percent of its count
TILE = 256
BLOCK = 1 << 22  # bytes of text in a block
BUCKET = 1 << 24  # bytes of text whose words meet in a bucket
SALTS = 4

_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def scanned(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts in order, the text each one is in, and whether its
    piece goes on from the word before."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if data else np.zeros(0, np.uint8)
    starts = starts - starts[0]
    kind = _KIND[raw]
    word = kind == 0
    first, last = word.copy(), word.copy()
    edges = starts[(starts > 0) & (starts < len(raw))]
    first[1:] &= ~word[:-1]
    first[edges] = word[edges]
    last[:-1] &= ~word[1:]
    last[edges - 1] = word[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets.astype(np.int64)),
                                             pa.py_buffer(_LOWER[raw[word]]))
    text = np.searchsorted(starts, begin, "right") - 1
    piece = np.cumsum(kind == _BREAK)[begin] if len(begin) else np.zeros(0, np.int64)
    goes_on = np.zeros(len(begin), bool)
    goes_on[1:] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
    return words, text, goes_on


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Non-negative numbers (as steps, if they only rise) in the narrowest
    width that holds them all, their bytes by place, compressed."""
    values = np.diff(values, prepend=0) if rising else values
    top = int(values.max()) if len(values) else 0
    width = max((top.bit_length() + 7) // 8, 1)
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width + 16 * rising]) + pa.compress(np.ascontiguousarray(planes), "zstd", asbytes=True)


def unpacked(data: pa.Buffer, n: int) -> np.ndarray:
    width, rising = data[0] % 16, data[0] >= 16
    planes = np.frombuffer(pa.decompress(data[1:], n * width, "zstd"), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    out = out.reshape(-1).view("<i8")
    return np.cumsum(out) if rising else out


def mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit numbers (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_hash(words: pa.LargeStringArray) -> np.ndarray:
    """A hash of each string: a polynomial over its bytes."""
    words = pa.concat_arrays([words])
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    raw = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    starts, size = ends[:-1] - ends[0], np.diff(ends)
    longest = int(size.max()) if len(size) else 0
    power = np.full(longest, 0x9E3779B97F4A7C15, np.uint64).cumprod()
    sums = np.zeros(len(raw) + 1, np.uint64)
    sums[1:] = np.cumsum((raw + np.uint64(1)) * power[np.arange(len(raw)) - np.repeat(starts, size)])
    return mixed(sums[starts + size] - sums[starts])


def _row(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``columns``, null in the schema's others."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _schema(arrow: pa.Schema):
    from pyspark.sql.pandas.types import from_arrow_schema
    return from_arrow_schema(arrow)


WORDS_OUT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("word", pa.list_(pa.string())),
                       ("start", pa.int64()), ("n", pa.binary()), ("total", pa.int64()), ("size", pa.int64()),
                       ("seq", pa.binary()), ("begins", pa.binary())])
PAIRS_OUT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                       ("left", pa.binary()), ("right", pa.binary()), ("n", pa.binary()), ("seq", pa.binary()),
                       ("begins", pa.binary()), ("ranks", pa.binary()), ("known", pa.int64())])
RANKED = pa.schema([("block", pa.int64()), ("size", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()),
                    ("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("left", pa.int64()),
                    ("right", pa.int64()), ("a", pa.int64())])


def _blocks(buckets: int):
    """Per block its text as local word numbers with the places where pieces
    begin, and per bucket and language the block's different words. Local
    numbers follow (bucket, language, word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, stop in text_blocks(batch.column("text"), BLOCK):
                langs = pc.dictionary_encode(batch.column("lang").slice(start, stop - start))
                words, text, goes_on = scanned(batch.column("text").slice(start, stop - start))
                if not len(words):
                    continue
                words = pc.dictionary_encode(words)
                n = len(words.dictionary)
                both = langs.indices.to_numpy().astype(np.int64)[text] * n + words.indices.to_numpy()
                known, at, count = np.unique(both, return_inverse=True, return_counts=True)
                lang, word = known // n, known % n
                bucket = (string_hash(words.dictionary)[word] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket * len(langs.dictionary) + lang, kind="stable")
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                yield _row(WORDS_OUT, bucket=[-1], block=[number], size=[len(at)], seq=[packed(place[at])],
                           begins=[packed(~goes_on)])
                lang, word, count, bucket = lang[order], word[order], count[order], bucket[order]
                first = np.flatnonzero(np.diff(bucket * len(langs.dictionary) + lang, prepend=-1))
                last = np.append(first[1:], len(order))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()),
                                                 words.dictionary.take(pa.array(word)).cast(pa.string()))
                yield _row(WORDS_OUT, bucket=bucket[first], block=np.full(len(first), number), start=first, word=lists,
                           lang=langs.dictionary.take(pa.array(lang[first])).cast(pa.string()),
                           n=[packed(count[f:e]) for f, e in zip(first, last, strict=True)],
                           total=np.add.reduceat(count, first))
                number += 1
    return run


def _ranked(batches: Iterator[pa.RecordBatch], least: int, buckets: int, keys) -> Iterator[pa.RecordBatch]:
    """Meet in a bucket: add up equal keys of all blocks, rank the frequent
    ones, and answer each block that sent them. ``keys(table, sizes)`` gives
    a number for each entry (equal for equal keys) and, for chosen entries, the
    columns of the result."""
    rows = [b for b in batches if len(b)]
    if not rows:
        return
    got = pa.Table.from_batches(rows)
    bucket = got["bucket"][0].as_py()
    sizes, code, named = keys(got)
    count = np.concatenate([unpacked(x.as_buffer(), n) for x, n in zip(got["n"], sizes, strict=True)])
    total = np.bincount(code, count).astype(np.int64)  # exact: sums stay below 2 ** 53
    frequent = np.flatnonzero(total >= least)
    ids = np.full(len(total), -1, np.int64)
    best = frequent[np.argsort(-total[frequent], kind="stable")]
    ids[best] = np.arange(len(best)) * buckets + bucket
    if len(best):
        one = np.zeros(len(total), np.int64)
        one[code] = np.arange(len(code))
        yield _row(RANKED, id=ids[best], a=total[best], **named(one[best]))
    ends = np.cumsum(sizes)
    for i, (block, start) in enumerate(zip(got["block"].to_pylist(), got["start"].to_pylist(), strict=True)):
        mine = ids[code[ends[i] - sizes[i]:ends[i]]]
        held = np.flatnonzero(mine >= 0)
        if len(held) and start is not None:
            yield _row(RANKED, block=[block], size=[len(held)], at=[packed(start + held, True)], ids=[packed(mine[held])])


def _rank_words(least: int, buckets: int):
    def keys(got: pa.Table):
        words = got["word"].combine_chunks()
        sizes = pc.list_value_length(words).to_numpy()
        flat = pc.dictionary_encode(words.flatten())
        langs = pc.dictionary_encode(got["lang"].combine_chunks())
        lang = np.repeat(langs.indices.to_numpy(), sizes).astype(np.int64)
        code = np.unique(lang * len(flat.dictionary) + flat.indices.to_numpy(), return_inverse=True)[1]
        return sizes, code, lambda one: {"lang": langs.dictionary.take(pa.array(lang[one])), "word": flat.take(
            pa.array(one)).dictionary_decode()}
    return lambda batches: _ranked(batches, least, buckets, keys)


def _rank_pairs(least: int, buckets: int):
    def keys(got: pa.Table):
        sizes = got["size"].to_numpy()
        left, right = (np.concatenate([unpacked(x.as_buffer(), n) for x, n in zip(got[c], sizes, strict=True)])
                       for c in ("left", "right"))
        order = np.lexsort((right, left))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)
        code = np.empty(len(order), np.int64)
        code[order] = np.cumsum(fresh) - 1
        return sizes, code, lambda one: {"left": left[one], "right": right[one]}
    return lambda batches: _ranked(batches, least, buckets, keys)


def tiled(left: np.ndarray, right: np.ndarray, left_ids: np.ndarray, right_ids: np.ndarray, tile: int):
    """Count pairs of numbers, whose ranks are ``left_ids[left]`` and
    ``right_ids[right]``. Returns left, right and count of each different pair
    and, for each occurrence, the place of its pair among them."""
    tops, left_tile = np.unique(left_ids // tile, return_inverse=True)
    sides, right_tile = np.unique(right_ids // tile, return_inverse=True)
    at = left_tile[left] * len(sides) + right_tile[right]
    if len(tops) * len(sides) > 1 << 22:
        at = np.unique(at, return_inverse=True)[1]
    held = np.bincount(at) >= tile * tile // 4
    dense = held[at]
    # dense tiles: one array, a cell per pair of ranks
    place = np.cumsum(held) - 1
    cell = ((place[at[dense]] * tile + left_ids[left[dense]] % tile) * tile + right_ids[right[dense]] % tile)
    full = np.bincount(cell)
    present = np.flatnonzero(full)
    some = np.zeros(len(full), np.int64)
    some[cell] = np.flatnonzero(dense)
    slot = np.zeros(len(full), np.int64)
    slot[present] = np.arange(len(present))
    # the other tiles: sorted coordinates
    _, sparse, where, count = np.unique((left[~dense].astype(np.int64) << 32) | right[~dense], return_index=True,
                                        return_inverse=True, return_counts=True)
    one = np.concatenate([some[present], np.flatnonzero(~dense)[sparse]])
    slots = np.empty(len(left), np.int64)
    slots[dense] = slot[cell]
    slots[~dense] = where + len(present)
    return left[one], right[one], np.concatenate([full[present], count]), slots


def sent(block: int, left: np.ndarray, right: np.ndarray, n: np.ndarray, buckets: int, answer: bool):
    """A block's pairs as rows to buckets, and the order they are sent in: by
    (bucket, left, right). Buckets answer by place in that order."""
    with np.errstate(over="ignore"):
        bucket = (mixed(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))
                  % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((right, left, bucket))
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    last = np.append(first[1:], len(order))
    parts = [order[f:e] for f, e in zip(first, last, strict=True)]
    return order, _row(PAIRS_OUT, bucket=bucket[order[first]], block=np.full(len(first), block), size=last - first,
                       left=[packed(left[p], True) for p in parts], right=[packed(right[p]) for p in parts],
                       n=[packed(n[p]) for p in parts], **({"start": first} if answer else {}))


def _received(group: pa.Table) -> tuple[int, dict, np.ndarray, np.ndarray]:
    """A block's number, its text's row, and the answers to it: places, ranks."""
    block = group["block"][0].as_py()
    answers = group.filter(pc.is_valid(group["at"]))
    texts = group.filter(pc.is_valid(group["seq"]))
    texts = {c: texts[c][0] for c in texts.column_names}
    sizes = answers["size"].to_pylist()
    at, ids = ([unpacked(x.as_buffer(), n) for x, n in zip(answers[c], sizes, strict=True)] for c in ("at", "ids"))
    none = [np.zeros(0, np.int64)]
    return block, texts, np.concatenate(at + none), np.concatenate(ids + none)


def _text(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Local word numbers of a block's text, and whether a piece begins there."""
    words, begins = (unpacked(row[c].as_buffer(), row["size"].as_py()) for c in ("seq", "begins"))
    return words, begins.astype(bool)


def _pairs_of(words: np.ndarray, starts: np.ndarray, ranks: np.ndarray, tile: int):
    """Places of pairs inside pieces, and the pairs as ``tiled`` gives them."""
    at = np.flatnonzero(~starts[1:])
    return at, tiled(words[at], words[at + 1], ranks, ranks, tile)


def _send_pairs(buckets: int, tile: int):
    """Per block: its text without the words that aren't frequent, as local
    numbers, their ranks, and its pairs to the buckets."""
    def run(group: pa.Table) -> pa.Table:
        block, texts, at, ids = _received(group)
        out = [_row(PAIRS_OUT, bucket=[])]
        if len(at):
            words, starts = _text(texts)
            local = np.full(max(int(words.max()), int(at.max())) + 1, -1, np.int64)
            ranks, place = np.unique(ids, return_inverse=True)
            local[at] = place
            words = local[words]
            # a word begins a piece also after one that isn't frequent
            starts = starts | np.append(True, words[:-1] < 0)
            words, starts = words[words >= 0], starts[words >= 0]
            _, (left, right, n, _) = _pairs_of(words, starts, ranks, tile)
            out.append(_row(PAIRS_OUT, bucket=[-1], block=[block], ranks=[packed(ranks, True)], known=[len(ranks)],
                            size=[len(words)], seq=[packed(words)], begins=[packed(starts)]))
            out.append(sent(block, ranks[left], ranks[right], n, buckets, True)[1])
        return pa.Table.from_batches(out)
    return run


def _send_triples(buckets: int, tile: int):
    def run(group: pa.Table) -> pa.Table:
        block, texts, places, ids = _received(group)
        out = [_row(PAIRS_OUT, bucket=[])]
        if len(places):
            words, starts = _text(texts)
            ranks = unpacked(texts["ranks"].as_buffer(), texts["known"].as_py())
            at, (left, right, n, slots) = _pairs_of(words, starts, ranks, tile)
            order, _ = sent(block, ranks[left], ranks[right], n, buckets, True)
            known, place = np.unique(ids, return_inverse=True)
            local = np.full(len(order), -1, np.int64)
            local[order[places]] = place
            pair = np.full(len(words), -1, np.int64)
            pair[at] = local[slots]
            start = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
            left, right, n, _ = tiled(pair[start], words[start + 2], known, ranks, tile)
            out.append(sent(block, known[left], ranks[right], n, buckets, False)[1])
        return pa.Table.from_batches(out)
    return run


def looked_up(rows: DataFrame, keys: list[str], other: DataFrame, spread: Column) -> DataFrame:
    """Join on ``keys`` (unique in ``other``), each key's rows split over salts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return (rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(SALTS)).cast("int"))
            .join(other.select("*", salts), [*keys, "_salt"]).drop("_salt"))


def score(a: str, left: str, right: str) -> Column:
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)))"
                  f" div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER, tile: int = TILE) -> DataFrame:
    """Each language's ``top`` phrases of two and three words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(docs), size // BUCKET)

    def ranked(rows: DataFrame, run, name: str) -> DataFrame:
        return materialise(rows.where("bucket >= 0").repartitionById(buckets, F.col("bucket")).mapInArrow(
            run(least, buckets), _schema(RANKED)), name)

    def answered(texts: DataFrame, answers: DataFrame) -> DataFrame:
        return (texts.where("bucket < 0").unionByName(answers.where("block IS NOT NULL").select("block", "size", "at", "ids"),
                                                      allowMissingColumns=True).groupBy("block"))

    blocks = materialise(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
                         .mapInArrow(_blocks(buckets), _schema(WORDS_OUT)), "phrase-words")
    totals = blocks.where("bucket >= 0").groupBy("lang").agg(F.sum("total").alias("n"))
    answers = ranked(blocks, _rank_words, "phrase-words")
    words = answers.where("id IS NOT NULL").select("id", "lang", "word", F.col("a").alias("f"))
    texts = materialise(answered(blocks.select("bucket", "block", "size", "seq", "begins"), answers).applyInArrow(
        _send_pairs(buckets, tile), _schema(PAIRS_OUT)), "phrase-pairs")
    answers = ranked(texts, _rank_pairs, "phrase-pairs")
    pairs = answers.where("id IS NOT NULL").select(F.col("id").alias("pid"), F.col("left").alias("w1"),
                                                   F.col("right").alias("w2"), "a")
    first = words.select(F.col("id").alias("w1"), "lang", F.col("f").alias("f1"))
    second = words.select(F.col("id").alias("w2"), F.col("f").alias("f2"))
    pairs = materialise(looked_up(looked_up(pairs, ["w1"], first, F.col("w2")), ["w2"], second, F.col("w1")),
                        "phrase-pairs")
    sent_on = answered(texts.select("bucket", "block", "size", "seq", "begins", "ranks", "known"), answers).applyInArrow(
        _send_triples(buckets, tile), _schema(PAIRS_OUT))
    triples = ranked(sent_on, _rank_pairs, "phrase-triples").select(
        F.col("left").alias("pid"), F.col("right").alias("w3"), "a")

    third = words.select(F.col("id").alias("w3"), F.col("f").alias("f3"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"))
    head = pairs.select("pid", "lang", "w1", "w2", F.col("a").alias("a12"), "f1")
    whole = looked_up(looked_up(triples, ["pid"], head, F.col("w3")), ["w3"], third, F.col("pid"))
    whole = materialise(looked_up(whole, ["w2", "w3"], tail, F.col("w1")), "phrase-triples")
    longer = (whole.select("w1", "w2", "a").unionByName(whole.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
              .groupBy("w1", "w2").agg(F.max("a").alias("longer")))
    two = (pairs.join(longer, ["w1", "w2"], "left")
           .where(~F.coalesce(100 * F.col("longer") >= cover * F.col("a"), F.lit(False)))
           .select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", F.col("f1").alias("l"),
                   F.col("f2").alias("r"), score("a", "f1", "f2").alias("score")))
    cuts = whole.withColumn("s1", score("a", "f1", "a23")).withColumn("s2", score("a", "a12", "f3"))
    early = F.col("s1") <= F.col("s2")
    three = cuts.select("lang", "w1", "w2", "w3", "a", F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
                        F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    return _top(materialise(two.unionByName(three), "phrase-scores"), words, totals, top)


def _top(scored: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top``. Words are looked up for the phrases that
    score and count no less than the last of these, ties included."""
    best = [F.desc("score"), F.desc("a")]
    last = (scored.select("lang", "score", "a").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
            .where(F.col("rank") <= top).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last")))
    held = scored.join(last, "lang").where(F.struct("score", "a") >= F.col("last")).drop("last")
    for k in ("1", "2", "3"):
        held = held.join(words.select(F.col("id").alias("w" + k), F.col("word").alias("word" + k)), "w" + k, "left")
    named = held.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))
    return (named.withColumn("rank", place).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words of all documents, for each language."""
    return mine(table(spark, sf_dir, "documents"))


def oracle(least: int = LEAST, top: int = TOP, cover: int = COVER) -> str:
    pieces = r"regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
             r"'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"
    cut = "(1000000::HUGEINT * a * a) // ({0}::HUGEINT * {1})"
    return f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest({pieces}) AS piece FROM documents),
    w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
    f1 AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL),
    f2 AS MATERIALIZED (SELECT lang, x[1] AS x1, x[2] AS x2, count(*) AS a FROM (SELECT lang,
        unnest(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) AS x FROM w) GROUP BY ALL
      HAVING count(*) >= {least}),
    f3 AS MATERIALIZED (SELECT lang, x[1] AS x1, x[2] AS x2, x[3] AS x3, count(*) AS a FROM (SELECT lang,
        unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS x FROM w) GROUP BY ALL
      HAVING count(*) >= {least}),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
    longer AS (SELECT lang, y1, y2, max(a) AS most FROM (SELECT lang, x1 AS y1, x2 AS y2, a FROM f3
      UNION ALL SELECT lang, x2, x3, a FROM f3) GROUP BY ALL),
    two AS (SELECT f2.lang, f2.x1 || ' ' || f2.x2 AS phrase, a, u.f AS l, v.f AS r FROM f2
      JOIN f1 u ON u.lang = f2.lang AND u.x = f2.x1 JOIN f1 v ON v.lang = f2.lang AND v.x = f2.x2
      LEFT JOIN longer g ON g.lang = f2.lang AND g.y1 = f2.x1 AND g.y2 = f2.x2
      WHERE g.most IS NULL OR 100 * g.most < {cover} * a),
    three AS (SELECT f3.lang, f3.x1 || ' ' || f3.x2 || ' ' || f3.x3 AS phrase, f3.a, u.f AS l1, q.a AS r1, p.a AS l2, v.f AS r2
      FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.x = f3.x1 JOIN f1 v ON v.lang = f3.lang AND v.x = f3.x3
      JOIN f2 p ON p.lang = f3.lang AND p.x1 = f3.x1 AND p.x2 = f3.x2
      JOIN f2 q ON q.lang = f3.lang AND q.x1 = f3.x2 AND q.x2 = f3.x3),
    cuts AS (SELECT *, {cut.format('l1', 'r1')} AS s1, {cut.format('l2', 'r2')} AS s2 FROM three),
    every AS (SELECT lang, phrase, a, l, r, {cut.format('l', 'r')} AS score FROM two
      UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END,
        least(s1, s2) FROM cuts),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed JOIN n USING (lang) WHERE rank <= {top}"""
