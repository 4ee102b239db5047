"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSION`` numbers +1 or -1, drawn from
the letter's code point, so that any script's letters have one. An n-gram's
vector binds its letters: the elementwise product of their vectors, each
rotated by its distance from the n-gram's end. A text's vector bundles (adds
up) the vectors of all its n-grams, and a language's prototype those of all
its training texts. A text gets the language whose prototype has the largest
cosine with the text's vector.

Letters are the characters that Unicode calls letters, in lower case; n-grams
of three run over words with one boundary mark on each side. Both passes work
on blocks of bounded size, however long a text is: the n-grams of a block are
counted per text, and the counts multiplied with the n-grams' vectors.
Prototypes are sums of whole numbers, the same for any split of the rows: a
task adds up its own texts, partial sums meet in salted groups, and only sums
per language and salt are brought together. They hold ``DIMENSION`` numbers a
language; a column of over ``MOST_LANGUAGES`` values is refused, as it names
no languages, so what is broadcast stays under 80 MB.

Results in special cases: a null text, an empty one or one without a letter
gives ``und`` with score 0, as does every text when nothing could be learned;
ties go to the smallest language name; repeated rows count and score as often
as they occur; rows of a null language teach nothing (an empty language is a
name like others); a null doc_id counts as held out; an empty table gives no
rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, table, text_blocks

DIMENSION = 1024
MOST_LANGUAGES = 10_000
BLOCK = 1 << 19  # bytes of text in a block
SLICE = 1 << 18  # characters of a block looked at together
WIDE = 1 << 21  # n-gram codes that are counted directly
ROWS = 512  # texts of a block
GRAMS = 2048  # n-grams whose vectors are built together
SALTS = 16


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point the code point of its letter in lower case, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


@lru_cache(maxsize=1 << 14)
def letter_vector(cp: int) -> np.ndarray:
    """The vector of a letter; 0 is the mark of a word's boundary."""
    return (np.random.default_rng([11, cp]).integers(0, 2, DIMENSION, np.int8) * 2 - 1).astype(np.int8)


def bound(grams: np.ndarray) -> np.ndarray:
    """Vectors of n-grams, rows of three code points."""
    known, at = np.unique(grams, return_inverse=True)
    plain = np.stack([letter_vector(int(cp)) for cp in known])
    a, b, c = at.reshape(grams.shape).T
    return (np.roll(plain, 2, axis=1)[a] * np.roll(plain, 1, axis=1)[b] * plain[c]).astype(np.float32)


def gram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """n-grams (rows of three code points) and their counts in each text
    (texts x n-grams), for one slice of the texts after the other."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    whole = "\n" + "\n".join(texts) + "\n"
    for start in range(0, len(whole) - 2, SLICE):
        low = letters()[np.frombuffer(whole[start:start + SLICE + 2].encode("utf-32-le"), np.uint32)]
        middle = np.flatnonzero(low[1:-1])
        if not len(middle):
            continue
        text = np.searchsorted(ends, start + middle, "right")
        known = np.flatnonzero(np.bincount(low))
        place = np.zeros(int(known[-1]) + 1, np.int64)
        place[known] = np.arange(len(known))
        low, n = place[low], len(known)
        codes = (low[middle] * n + low[middle + 1]) * n + low[middle + 2]
        if n ** 3 <= WIDE:
            present = np.flatnonzero(np.bincount(codes, minlength=n ** 3))
            at = np.zeros(n ** 3, np.int64)
            at[present] = np.arange(len(present))
            at = at[codes]
        else:
            present, at = np.unique(codes, return_inverse=True)
        first, size = int(text[0]), int(text[-1] - text[0]) + 1
        grams = known[np.stack([present // (n * n), present // n % n, present % n], axis=1)]
        for g in range(0, len(present), GRAMS):
            mine = (at >= g) & (at < g + GRAMS)
            width = min(GRAMS, len(present) - g)
            found = np.zeros((len(texts), width), np.float32)
            found[first:first + size] = np.bincount((text[mine] - first) * width + at[mine] - g,
                                                    minlength=size * width).reshape(size, width)
            yield grams[g:g + GRAMS], found


def bundled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vector and number of n-grams of each text."""
    out = np.zeros((len(texts), DIMENSION), np.float64)
    total = np.zeros(len(texts), np.int64)
    for grams, found in gram_counts(texts):
        # whole numbers under 2 ** 24 in a block: exact in 32 bits
        out += found @ bound(grams)
        total += found.sum(axis=1).astype(np.int64)
    return out, total


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start, end in text_blocks(batch.column("text"), BLOCK):
        for s in range(start, end, ROWS):
            yield batch.slice(s, min(ROWS, end - s))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return pc.fill_null(batch.column("text"), "").to_pylist()


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per language of a task's texts; flushed when languages are many."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for b in blocks(batch):
            names = pc.dictionary_encode(b.column("name"))
            vectors, total = bundled(_texts(b))
            for i, name in enumerate(names.dictionary.to_pylist()):
                mine = (names.indices.to_numpy() == i) & (total > 0)
                if mine.any():
                    got = vectors[mine].sum(axis=0).astype(np.int64)
                    sums[name] = sums[name] + got if name in sums else got
            if len(sums) > 256:
                yield _rows(sums)
                sums = {}
    yield _rows(sums)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for name, v in zip(b.column("name").to_pylist(), _matrix(b.column("vector")), strict=True):
            sums[name] = sums[name] + v if name in sums else v.copy()
        if len(sums) > 256:
            yield _rows(sums)
            sums = {}
    yield _rows(sums)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), DIMENSION)


def _rows(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(list(sums.values())) if sums else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()),
         pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * DIMENSION, pa.int32()), pa.array(flat))],
        ["name", "vector"])


def fit(docs: DataFrame, training: Column, name: str = "lang") -> DataFrame:
    """Prototypes (name, vector: array<bigint>) of the texts for which ``training`` holds."""
    schema = "name string, vector array<bigint>"
    rows = (docs.where(training & F.col(name).isNotNull() & F.col("text").isNotNull())
            .select(F.col(name).cast("string").alias("name"), "text"))
    partial = materialise(rows.mapInArrow(_partial, schema), "language-sums")
    met = (partial.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
           .repartition(partitions(docs), "name", "salt").select("name", "vector").mapInArrow(_merged, schema))
    cells = met.select("name", F.posexplode("vector").alias("i", "v")).groupBy("name", "i").agg(F.sum("v").alias("v"))
    one = cells.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("cells"))
    return materialise(one.select("name", F.col("cells.v").alias("vector")), "language-prototypes")


def predict(docs: DataFrame, prototypes: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang_pred, score (the cosine, 0 where it is below)."""
    spark = docs.sparkSession
    if prototypes.count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages: the column doesn't hold language names")
    model = sorted((r.name.encode(), r.vector) for r in prototypes.collect())
    names = np.array([n.decode() for n, _ in model] + ["und"], object)
    weights = np.array([v for _, v in model], np.float64).reshape(len(model), DIMENSION)
    weights /= np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)
    shared = spark.sparkContext.broadcast((names, weights.astype(np.float32).T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        for batch in batches:
            for b in blocks(batch):
                vectors, total = bundled(_texts(b))
                length = np.linalg.norm(vectors, axis=1)
                known = (total > 0) & (weights.shape[1] > 0)
                best, score = np.full(len(total), len(names) - 1), np.zeros(len(total))
                if known.any():
                    cosine = vectors[known] @ weights / np.maximum(length[known], 1e-12)[:, None]
                    best[known] = cosine.argmax(axis=1)
                    score[known] = np.clip(cosine.max(axis=1), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keep], pa.array(names[best], pa.string()), pa.array(score)],
                    [*keep, "lang_pred", "score"])

    rows = docs.select(*keep, "text")
    schema = (docs.select(*keep).withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))).schema
    return rows.mapInArrow(run, schema)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototypes from the documents that aren't held out; a language for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", held_out().alias("held_out"))
    return predict(docs, fit(docs, ~F.col("held_out")), ["doc_id", "held_out"])
