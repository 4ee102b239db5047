"""Tokenise, profile and pack text into fixed-length chunks.

Packing follows GPT-style chunking: the documents of one batch of
``batch_rows`` rows form one stream ``sep d1 sep d2 ...`` that is cut into
chunks of exactly ``chunk`` tokens; the last chunk of every batch is
dropped, even when full, unless ``return_final`` is set. Batches follow an
explicit order, so the result does not depend on core counts.

The stream is never exploded to single tokens: each row knows its start
offset in its batch (a running sum over a window bounded by
``batch_rows``), emits one slice per chunk it overlaps, and chunks are
re-assembled from at most ``chunk`` tokens of slices.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import c, whitespace_tokens
from tessera.operators.positions import laid_out, prefix_sum, with_index

DEFAULT_SEPARATOR = "<|endoftext|>"  # fixed value: separator when the tokenizer has no eos token

PROFILE_QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99, 0.999)  # fixed values: profiled percentiles


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens",
             tokenizer: Callable[[list[str]], list[list]] | None = None,
             id_type: T.DataType = T.IntegerType()) -> DataFrame:
    """Tokenise a text column (D1); pre-tokenised input passes through (A4).

    Default: whitespace tokens, a JVM regex. A supplied ``tokenizer`` is a
    batch function ``list[str] -> list[list[int]]`` run through an
    Arrow-batched pandas UDF (one call per batch, never per row).
    """
    if out in df.columns:
        return df
    if tokenizer is None:
        return df.withColumn(out, whitespace_tokens(text))

    @F.pandas_udf(T.ArrayType(id_type))
    def _encode(s: pd.Series) -> pd.Series:
        return pd.Series(tokenizer(s.fillna("").tolist()))

    return df.withColumn(out, _encode(F.col(text)))


def token_lengths(df: DataFrame, text: str = "text", keys=("doc_id",),
                  out: str = "n_tokens") -> DataFrame:
    """Token count per row, keeping only the keys and the count."""
    return df.select(*keys, F.size(whitespace_tokens(text)).cast("bigint").alias(out))


def length_profile(df: DataFrame, length: str = "n_tokens", by=None, exact: bool = True,
                   accuracy: int = 10000) -> DataFrame:
    """Length statistics (D3): count, min, max, mean, population std and
    linear-interpolated percentiles 50/75/90/95/99/99.9.

    ``percentile`` is exact; it keeps one counter per distinct length, so
    its state is bounded by the longest document, not by the row count, and
    it merges map-side partial aggregates. ``exact=False`` uses
    ``percentile_approx`` (a fixed-size sketch; nearest rank, not
    interpolated). Empty input yields no row.
    """
    n = F.col(length)
    qs = F.array(*[F.lit(q) for q in PROFILE_QUANTILES])
    pct = F.percentile(n, qs) if exact else F.percentile_approx(n, qs, accuracy).cast("array<double>")
    aggs = [F.count(n).alias("n_rows"), F.min(n).alias("min_len"), F.max(n).alias("max_len"),
            F.avg(n).alias("mean_len"), F.stddev_pop(n).alias("std_len"), pct.alias("_pct")]
    g = df.groupBy(*([by] if isinstance(by, str) else (by or [])))
    prof = g.agg(*aggs).where(F.col("n_rows") > 0)
    names = ["p50", "p75", "p90", "p95", "p99", "p999"]
    return prof.select(*([by] if isinstance(by, str) else list(by or [])),
                       "n_rows", "min_len", "max_len",
                       "mean_len", "std_len", *[F.col("_pct")[i].alias(nm) for i, nm in enumerate(names)])


def _assemble_chunks(wide: DataFrame, C: int) -> DataFrame:
    """Rows ``(_batch, _start, _n, _first, _last, _toks)`` -> chunks.

    Each row is sliced inside the row into the chunks ``_first.._last`` it
    overlaps, and only the slices are exploded (exploding first would copy
    the whole token array once per chunk). A chunk is re-assembled from at
    most ``C`` tokens of slices, ordered by their start offset.
    """
    def piece(ch):
        lo = F.greatest(ch * C - F.col("_start"), F.lit(0))
        hi = F.least((ch + 1) * C - F.col("_start"), F.col("_n"))
        return F.struct(ch.alias("chunk"), F.slice("_toks", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("p"))

    pieces = (wide.select(F.col("_batch").alias("batch"), "_start",
                          F.explode(F.transform(F.sequence(F.col("_first"), F.col("_last")), piece)).alias("_s"))
              .select("batch", F.col("_s.chunk").alias("chunk"), "_start", F.col("_s.p").alias("_piece")))
    return (pieces.groupBy("batch", "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("_start", "_piece"))).alias("_parts"))
            .select("batch", "chunk", F.flatten(F.transform("_parts", lambda p: p["_piece"])).alias("input_ids")))


def chunk_length(max_seq_len: int, model_max: int | None = None) -> int:
    """Tokens per chunk: the asked length, at most what the tokenizer's model takes."""
    return max_seq_len if model_max is None else min(max_seq_len, model_max)


def pack(df: DataFrame, tokens: str, order, chunk: int = 2048, batch_rows: int = 2048,
         separator=DEFAULT_SEPARATOR, return_final: bool = False,
         on_empty: str = "error") -> DataFrame:
    """Fixed-length packing with separators.

    Returns ``(batch, chunk, input_ids)`` where ``input_ids`` holds exactly
    ``chunk`` tokens (the kept final chunk may be shorter).
    ``on_empty='error'`` fails when a batch packs to zero chunks (as the
    reference does); ``'skip'`` yields no rows for it. ``order`` must be
    unique (a key).

    Plan: one range exchange puts the rows (tokens included) in order, and
    each task adds its running token count; the result is written once to the
    shared scratch folder, so tokens are computed and moved once. Batch
    offsets come from its narrow columns: a table with a row for each batch
    and partition, which is joined back (AQE broadcasts it when it is small).
    Tokens then move once more, as slices of the chunks they belong to.
    """
    if on_empty not in ("error", "skip"):
        raise ValueError("on_empty must be 'error' or 'skip'")
    C = int(chunk)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    keys = [f"_o{i}" for i in range(len(order))]
    base = df.select(*[c(o).alias(k) for o, k in zip(order, keys)], F.col(tokens).alias("_t"))
    laid = laid_out(base.withColumn("_n", (F.size("_t") + 1).cast("bigint")), keys, "_n")
    # a row per partition
    rows = laid.groupBy("_piece").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offset = rows.select("_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"))
    x = laid.join(F.broadcast(offset), "_piece").withColumn(
        "_batch", F.floor((F.col("_off") + F.col("_row")) / batch_rows).cast("bigint")).drop("_off")
    # a batch lies in few partitions: windows hold a handful of rows
    parts = x.groupBy("_batch", "_piece").agg(F.min("_cum").alias("_low"), F.sum("_n").alias("_part"))
    w = Window.partitionBy("_batch")
    parts = parts.select("_batch", "_piece", "_low", F.sum("_part").over(w).alias("_total"), F.coalesce(F.sum("_part").over(
        w.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry"))
    x = x.join(parts, ["_batch", "_piece"]).withColumn("_start", F.col("_carry") + F.col("_cum") - F.col("_low")).withColumn(
        "_end", F.col("_start") + F.col("_n"))
    n_chunks = F.ceil(F.col("_total") / C) if return_final else F.floor((F.col("_total") - 1) / C)
    last = F.least(F.floor((F.col("_end") - 1) / C), n_chunks - 1)
    if on_empty == "error":
        last = F.when(n_chunks > 0, last).otherwise(
            F.raise_error(F.lit("a batch holds less than one chunk and a token: keep final chunks, "
                                "use larger batches or smaller chunks")))
    sep = F.array(F.lit(separator).cast(df.schema[tokens].dataType.elementType))
    wide = x.select("_batch", "_start", "_n", F.floor(F.col("_start") / C).alias("_first"), last.cast("bigint").alias("_last"),
                    F.concat(sep, F.col("_t")).alias("_toks")).where(F.col("_first") <= F.col("_last"))
    return _assemble_chunks(wide, C)


def pack_segments(df: DataFrame, tokens: str, doc, seq, chunk: int = 2048, batch_rows: int = 2048,
                  separator=DEFAULT_SEPARATOR, return_final: bool = False,
                  on_empty: str = "error") -> DataFrame:
    """:func:`pack` for documents stored as ordered segments (one row per
    segment, e.g. one rendered chat message): the stream is
    ``sep + segments of doc 1 + sep + segments of doc 2 ...`` and batches hold
    ``batch_rows`` documents.

    Nothing is grouped per document: a segment's offset inside its document
    is its global token prefix minus the document's first prefix (two-level
    prefix sum plus a per-document ``min`` with map-side combine), so a
    document holding a large share of all segments still spreads over many
    tasks. Document offsets inside a batch use a window bounded by
    ``batch_rows`` documents.
    """
    if on_empty not in ("error", "skip"):
        raise ValueError("on_empty must be 'error' or 'skip'")
    C = int(chunk)
    doc = list(doc) if isinstance(doc, (list, tuple)) else [doc]
    seq = list(seq) if isinstance(seq, (list, tuple)) else [seq]
    dk = [f"_d{i}" for i in range(len(doc))]
    sk = [f"_s{i}" for i in range(len(seq))]
    base = df.select(*[c(o).alias(k) for o, k in zip(doc, dk)], *[c(o).alias(k) for o, k in zip(seq, sk)],
                     F.col(tokens).alias("_t"))
    seg = prefix_sum(base.select(*dk, *sk, F.size("_t").cast("bigint").alias("_m")), dk + sk, "_m", "_g",
                     inclusive=False)
    docs = seg.groupBy(*dk).agg(F.min("_g").alias("_g0"), (F.sum("_m") + 1).alias("_n"),
                                F.min(F.struct(*sk)).alias("_first"))
    x = with_index(docs, dk, "_idx").withColumn("_batch", F.floor(F.col("_idx") / batch_rows).cast("bigint"))
    running = Window.partitionBy("_batch").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    x = (x.withColumn("_end", F.sum("_n").over(running))
          .withColumn("_total", F.sum("_n").over(Window.partitionBy("_batch")))
          .withColumn("_dstart", F.col("_end") - F.col("_n")))
    n_chunks = F.ceil(F.col("_total") / C) if return_final else F.floor((F.col("_total") - 1) / C)
    chunks_ok = F.when(n_chunks > 0, n_chunks) if on_empty == "skip" else F.when(n_chunks > 0, n_chunks).otherwise(
        F.raise_error(F.lit("a batch holds less than one chunk and a token: "
                            "keep final chunks, use larger batches or smaller chunks")))
    docs = x.select(*dk, "_batch", "_dstart", "_g0", "_first", F.coalesce(chunks_ok, F.lit(0)).alias("_nc"))
    first = F.struct(*[F.col(k) for k in sk]) == F.col("_first")
    spans = (seg.join(docs, dk)
             .withColumn("_isfirst", first)
             .withColumn("_start", F.when(F.col("_isfirst"), F.col("_dstart"))
                         .otherwise(F.col("_dstart") + 1 + F.col("_g") - F.col("_g0")))
             .withColumn("_n", F.col("_m") + F.col("_isfirst").cast("bigint")))
    last = F.least(F.floor((F.col("_start") + F.col("_n") - 1) / C), F.col("_nc") - 1)
    spans = (spans.select(*dk, *sk, "_batch", "_start", "_n", "_isfirst",
                          F.floor(F.col("_start") / C).alias("_first"), last.cast("bigint").alias("_last"))
             .where((F.col("_n") > 0) & (F.col("_first") <= F.col("_last"))))
    sep = F.array(F.lit(separator).cast(df.schema[tokens].dataType.elementType))
    wide = base.join(spans, dk + sk).select(
        "_batch", "_start", "_n", "_first", "_last",
        F.when(F.col("_isfirst"), F.concat(sep, F.col("_t"))).otherwise(F.col("_t")).alias("_toks"))
    return _assemble_chunks(wide, C)


def chunk_fingerprint(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """``(batch, chunk, n_tokens, chunk_md5)`` view of packed chunks for checks."""
    return df.select("batch", "chunk", F.size(ids).cast("bigint").alias("n_tokens"),
                     F.md5(F.array_join(F.col(ids).cast("array<string>"), " ")).alias("chunk_md5"))


def hashed_ids(tokens, vocab_bits: int = 16) -> Column:
    """Token ids from a hashing vocabulary: 1 plus the first ``vocab_bits``
    bits of the token's md5, folded so that the largest id still fits; 0 is
    left free for separators. Words may share an id, as in any such vocabulary."""
    digits, size = vocab_bits // 4, (1 << vocab_bits) - 1
    return F.transform(c(tokens), lambda t: (F.conv(F.substring(F.md5(t), 1, digits), 16, 10).cast("int") % size) + 1)


_TOKENIZERS: dict = {}


def tokenizer_from_file(path: str, add_special_tokens: bool = False):
    """Batch function for :func:`tokenize` backed by a ``tokenizer.json`` file.

    The tokenizer is loaded once per Python worker (cached by path) and
    encodes a whole Arrow batch with ``encode_batch``. Requires the
    ``tokenizers`` package on the workers; the path must be readable there.
    """
    def encode(texts: list[str]) -> list[list[int]]:
        tok = _TOKENIZERS.get(path)
        if tok is None:
            try:
                from tokenizers import Tokenizer
            except ImportError as e:  # pragma: no cover - environment dependent
                raise ImportError("tokenizer_from_file needs the `tokenizers` package") from e
            tok = _TOKENIZERS[path] = Tokenizer.from_file(path)
        return [e.ids for e in tok.encode_batch(texts, add_special_tokens=add_special_tokens)]
    return encode
