"""Sparse coding of vectors: encode to the k strongest dictionary entries,
decode, residual losses, and per-entry statistics (E1-E18).

Data layout
-----------
* vectors: one row per vector, ``(id, vec array<double|float>)``.
* dictionary entries: ``(latent_id bigint, w_enc array<double>, b_enc double,
  w_dec array<double>)``; the decoder bias ``b_dec`` (length d) and the
  optional skip matrix are driver-side parameters (bounded by d, d*d).
* codes: long form ``(id, latent_id, act)``.

Execution
---------
Pre-activations are a dense product of every vector with every entry, so
they are computed per Arrow batch with BLAS (never a join that pairs rows with
entries). The dictionary is written to the shared scratch folder in blocks of
entries of bounded size, and tasks open the blocks they need there: no
parameter passes the driver, whatever the number of entries. A slice of rows
goes over all blocks with a running selection, one block in memory at a time,
and then over them again to decode; this is the same for one block and for
many, so a dictionary's size changes nothing but the number of blocks. Vectors
are read once and never leave their partition.

Rows may be named by several columns (``id_col`` takes a list), which pass
through with their types. Rows without a vector have no codes and no
reconstruction and are left out.

Decoding from a codes table is an equi-join of codes with the entries
(broadcast when the entry table is under the budget, else a join salted
against entries that hold a large share of the codes) and a sum of at most k
scaled rows per vector.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import as_double_array, c, dot, l2_norm, vscale, vsub
from tessera.sources.store import open_store

# Fixed value: float32 machine epsilon used when unit-normalising rows.
F32_EPS = 1.1920929e-07

# Default budget for a parameter block (bytes).
BROADCAST_BUDGET = 64 * 1024 * 1024

# Vectors that go over the blocks together when there are several (bytes).
SLICE_BYTES = 32 * 1024 * 1024

# Copies of an entry in a salted join.
SALTS = 16


@dataclass
class SparseDictionary:
    """A k-sparse dictionary: entry table plus driver-side bias parameters."""
    entries: DataFrame
    b_dec: list
    k: int
    transcode: bool = False
    w_skip: list | None = None  # d x d, applied as x @ W_skip^T
    activation: str = "topk"
    _meta: dict = field(default_factory=dict, repr=False)

    @property
    def d(self) -> int:
        return len(self.b_dec)

    def meta(self) -> dict:
        """Entry count and id range (one small aggregate, cached)."""
        if not self._meta:
            r = self.entries.agg(F.count(F.lit(1)).alias("n"), F.min("latent_id").alias("lo"),
                                 F.max("latent_id").alias("hi")).first()
            self._meta.update(n=int(r["n"]), lo=int(r["lo"] if r["lo"] is not None else 0),
                              hi=int(r["hi"] if r["hi"] is not None else -1))
        return self._meta

    @property
    def num_latents(self) -> int:
        return self.meta()["n"]

    def entry_bytes(self) -> int:
        return self.num_latents * max(self.d, 1) * 8 * 2

    def blocks(self, budget: int = BROADCAST_BUDGET) -> list[tuple[int, int]]:
        """Latent-id ranges ``[lo, hi)`` holding at most ``budget`` bytes of
        parameters each.

        Boundaries are taken by rank (every ``rows_per_block``-th id in id
        order, from the global index), so sparse or clustered ids still give
        blocks of bounded size; only the boundaries reach the driver.
        """
        m = self.meta()
        if m["n"] == 0:
            return [(0, 0)]
        if self.entry_bytes() <= budget:
            return [(m["lo"], m["hi"] + 1)]
        key = (budget, "blocks")
        if key not in self._meta:
            from tessera.operators.positions import with_index
            per_block = max(1, budget // (max(self.d, 1) * 8 * 2))
            idx = with_index(self.entries.select("latent_id"), ["latent_id"], "_r")
            starts = [r["latent_id"] for r in
                      idx.where(F.col("_r") % per_block == 0).orderBy("latent_id").collect()]
            self._meta[key] = [(lo, hi) for lo, hi in zip(starts, starts[1:] + [m["hi"] + 1])]
        return self._meta[key]

    def stored(self, budget: int = BROADCAST_BUDGET, dead=None) -> list:
        """The dictionary in blocks of at most ``budget`` bytes that tasks open
        in the shared folder. ``dead``: a table or list of ``latent_id``."""
        from tessera.session import scratch_path
        key = (budget, "stored")
        if dead is None and key in self._meta:
            return self._meta[key]
        spark, starts = self.entries.sparkSession, [lo for lo, _ in self.blocks(budget)]
        rows = self.entries.select("latent_id", "w_enc", "b_enc", "w_dec", block_of(starts).alias("block"))
        if dead is not None:
            rows = rows.join(dead_ids(spark, dead).withColumn("dead", F.lit(True)), "latent_id", "left")
        path = scratch_path(spark, "dictionary")
        write_blocks(rows, path, ["block"], len(starts))
        out = [StoredBlock(f"{path}/block={i}", self.d, self.b_dec, self.transcode) for i in range(len(starts))]
        if dead is None:
            self._meta[key] = out
        return out

    def skip_matrix(self) -> np.ndarray | None:
        """The skip term's d x d parameter; a table holds it as (row, w)."""
        if self.w_skip is None:
            return None
        if isinstance(self.w_skip, DataFrame):
            return _matrix(self.w_skip.orderBy("row").toArrow().column("w"), self.d)
        return np.asarray(self.w_skip, dtype=np.float64)


def _matrix(column, d: int) -> np.ndarray:
    """A column of lists of ``d`` numbers as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, d)


def _lists(x: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def dead_ids(spark, dead) -> DataFrame:
    """Distinct ``latent_id``s of a table or list."""
    if not isinstance(dead, DataFrame):
        dead = spark.createDataFrame([(int(i),) for i in dead], "latent_id bigint")
    return dead.select("latent_id").distinct()


def block_of(starts: list[int]) -> Column:
    """Number of the block of an entry: the last one that starts at or below it."""
    if len(starts) == 1:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(int(x)) for x in starts]), lambda x: x <= F.col("latent_id"))) - 1


def write_blocks(rows: DataFrame, path: str, by: list[str], n: int) -> None:
    """A parameter folder: ``rows`` in sub-folders by the columns ``by``, about
    a file each."""
    rows.repartition(max(n, 1), *by).write.mode("overwrite").partitionBy(*by).parquet(path)


@lru_cache(maxsize=1)
def _opened(path: str, d: int) -> dict:
    """A block's parameters by ``latent_id``. A worker keeps the last one it
    opened, so tasks of a dictionary of one block open it once."""
    store, at = open_store(path)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    tables = []
    for f in sorted(i.path for i in found if i.base_name.endswith(".parquet")):
        with store.open_input_file(f) as file:
            tables.append(pq.ParquetFile(file).read())
    if not tables:
        return {"ids": np.zeros(0, np.int64), "w_enc": np.zeros((0, d)), "b_enc": np.zeros(0), "w_dec": np.zeros((0, d)),
                "dead": np.zeros(0, bool)}
    t = pa.concat_tables(tables).sort_by("latent_id")
    out = {"ids": t["latent_id"].to_numpy().astype(np.int64), "w_enc": _matrix(t["w_enc"], d),
           "b_enc": t["b_enc"].to_numpy().astype(np.float64), "w_dec": _matrix(t["w_dec"], d)}
    if "dead" in t.column_names:
        out["dead"] = np.asarray(t["dead"].is_valid())
    return out


@dataclass(frozen=True)
class StoredBlock:
    """A block of entries in a parameter folder, by its sub-folder's path."""
    path: str
    d: int
    b_dec: list = field(repr=False)
    transcode: bool

    @property
    def value(self) -> dict:
        return {**_opened(self.path, self.d), "b_dec": np.asarray(self.b_dec, np.float64), "transcode": self.transcode}


def held_one_by_one(blocks: list):
    """The parameters of blocks, one in memory at a time."""
    for b in blocks:
        yield b.value


# ------------------------------------------------------------------ dense kernels (per Arrow batch)

def topk_indices(z: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k largest values per row; ties go to the lowest index.

    Uses a partition (O(L)) rather than a full sort; the result is ordered by
    value descending, index ascending.
    """
    n, L = z.shape
    k = min(k, L)
    if k == 0 or n == 0:
        return np.zeros((n, k), dtype=np.int64)
    kth = np.partition(z, L - k, axis=1)[:, L - k][:, None]
    gt = z > kth
    eq = z == kth
    need = k - gt.sum(axis=1, keepdims=True)
    sel = gt | (eq & (np.cumsum(eq, axis=1) <= need))
    cols = np.nonzero(sel)[1].reshape(n, k)
    vals = np.take_along_axis(z, cols, axis=1)
    order = np.lexsort((cols, -vals), axis=1)
    return np.take_along_axis(cols, order, axis=1)


def pre_activations(x: np.ndarray, p: dict) -> np.ndarray:
    """relu(W_enc (x - b_dec) + b_enc); no centring for transcoders."""
    xc = x if p["transcode"] else x - p["b_dec"]
    return np.maximum(xc @ p["w_enc"].T + p["b_enc"], 0.0)


def groupmax_indices(z: np.ndarray, k: int) -> np.ndarray:
    """Per contiguous group of L/k entries, the index of the maximum."""
    n, L = z.shape
    if L % k:
        raise ValueError("num_latents must be divisible by k for groupmax")
    g = L // k
    return np.argmax(z.reshape(n, k, g), axis=2) + np.arange(0, L, g)[None, :]


def _rows_per_slice(L: int) -> int:
    return max(1, (1 << 22) // max(L, 1))  # bound the dense n x L scratch to ~32 MB


def strongest(x: np.ndarray, blocks: list, k: int, dead: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(activations, latent ids) of the k strongest (dead) entries per vector,
    strongest first, ties by id: a running top-k over the blocks."""
    act, ids = np.zeros((len(x), 0)), np.zeros((len(x), 0), np.int64)
    for p in held_one_by_one(blocks):
        best, found = [], []
        for part in _parts(x, len(p["ids"])):
            z, own = pre_activations(part, p), p["ids"]
            if dead:
                z, own = z[:, p["dead"]], own[p["dead"]]
            idx = topk_indices(z, k)
            best.append(np.take_along_axis(z, idx, 1))
            found.append(own[idx])
        act, ids = np.concatenate([act, np.concatenate(best)], 1), np.concatenate([ids, np.concatenate(found)], 1)
        order = np.lexsort((ids, -act), axis=1)[:, :k]
        act, ids = np.take_along_axis(act, order, 1), np.take_along_axis(ids, order, 1)
    return act, ids


def _parts(x: np.ndarray, width: int) -> list[np.ndarray]:
    """Rows whose products with ``width`` entries fit the scratch memory."""
    step = _rows_per_slice(width)
    return [x[i:i + step] for i in range(0, max(len(x), 1), step)]


def group_maxima(x: np.ndarray, blocks: list, k: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(activations, latent ids) of the strongest entry of each of k groups of
    consecutive entries; a group may lie in several blocks."""
    if total % k:
        raise ValueError(f"group-max needs a number of entries ({total}) that k ({k}) divides")
    width, seen = total // k, 0
    act, ids = np.full((len(x), k), -np.inf), np.full((len(x), k), -1, np.int64)
    for p in held_one_by_one(blocks):
        n, row = len(p["ids"]), 0
        for part in _parts(x, n):
            z, at = pre_activations(part, p), 0
            here = slice(row, row + len(part))
            while at < n:
                group = (seen + at) // width
                end = min((group + 1) * width - seen, n)
                best = np.argmax(z[:, at:end], axis=1) + at
                value = z[np.arange(len(part)), best]
                more = np.flatnonzero(value > act[here, group])
                act[row + more, group], ids[row + more, group] = value[more], p["ids"][best[more]]
                at = end
            row += len(part)
        seen += n
    return act, ids


def selected(x: np.ndarray, blocks: list, k: int, activation: str, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of each vector under the dictionary's activation."""
    return group_maxima(x, blocks, k, total) if activation == "groupmax" else strongest(x, blocks, k)


def rebuilt(act: np.ndarray, ids: np.ndarray, blocks: list, bias: np.ndarray) -> np.ndarray:
    """``bias`` plus the scaled decoder rows of each vector's codes."""
    out = np.tile(bias, (len(act), 1))
    for p in held_one_by_one(blocks):
        pos = np.minimum(np.searchsorted(p["ids"], ids), max(len(p["ids"]) - 1, 0))
        rows, cols = np.nonzero(p["ids"][pos] == ids) if len(p["ids"]) and ids.size else (np.empty(0, int),) * 2
        if len(rows):
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            scaled = act[rows, cols][:, None] * p["w_dec"][pos[rows, cols]]
            out[rows[first]] += np.add.reduceat(scaled, first, axis=0)
    return out


def _names(id_col) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def _slices(batches, blocks: list, d: int, widest: int):
    """(batch of bounded rows, its vectors). With several blocks a slice is as
    large as memory allows, as each slice opens every block."""
    step = _rows_per_slice(widest)
    if len(blocks) > 1:
        step = max(step, SLICE_BYTES // (8 * max(d, 1)))
    for b in batches:
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            yield part, _matrix(part.column("_vec"), d)


def _source(df: DataFrame, names: list[str], vec_col: str, *more) -> DataFrame:
    return df.where(F.col(vec_col).isNotNull()).select(*names, as_double_array(vec_col).alias("_vec"), *more)


# ------------------------------------------------------------------ encode

def encode(df: DataFrame, dictionary: SparseDictionary, id_col="id", vec_col: str = "vec",
           k: int | None = None, dead=None, budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Codes ``(id columns, latent_id, act)``: the k strongest entries per vector
    (E2+E3), or one maximum per group with ``activation='groupmax'`` (E4).

    ``dead`` (a table or list of ids) restricts selection to those entries (E11).
    """
    k, names, d = dictionary.k if k is None else k, _names(id_col), dictionary.d
    total, activation = dictionary.num_latents, dictionary.activation
    if dead is None and activation == "groupmax" and total % k:
        raise ValueError(f"group-max needs a number of entries ({total}) that k ({k}) divides")
    blocks = dictionary.stored(budget, dead)
    widest = min(total, max(1, budget // (max(d, 1) * 16)))
    only_dead = dead is not None

    def run(batches):
        for b, x in _slices(batches, blocks, d, widest):
            act, ids = strongest(x, blocks, k, dead=True) if only_dead else selected(x, blocks, k, activation, total)
            rows = pa.array(np.repeat(np.arange(len(x)), ids.shape[1]))
            yield pa.RecordBatch.from_arrays([*[b.column(n).take(rows) for n in names], pa.array(ids.ravel()),
                                              pa.array(act.ravel())], [*names, "latent_id", "act"])

    schema = T.StructType([*[df.schema[n] for n in names], T.StructField("latent_id", T.LongType()),
                           T.StructField("act", T.DoubleType())])
    return _source(df, names, vec_col).mapInArrow(run, schema)


def pre_acts_long(df: DataFrame, dictionary: SparseDictionary, id_col="id", vec_col: str = "vec",
                  budget: int = BROADCAST_BUDGET) -> DataFrame:
    """All pre-activations in long form ``(id columns, latent_id, act)`` (E2):
    one row for each vector and entry, so meant for checks."""
    names, d = _names(id_col), dictionary.d
    blocks = dictionary.stored(budget)
    widest = min(dictionary.num_latents, max(1, budget // (max(d, 1) * 16)))

    def run(batches):
        for b, x in _slices(batches, blocks, d, widest):
            for p in held_one_by_one(blocks):
                z = pre_activations(x, p)
                rows = pa.array(np.repeat(np.arange(len(x)), z.shape[1]))
                yield pa.RecordBatch.from_arrays([*[b.column(n).take(rows) for n in names],
                                                  pa.array(np.tile(p["ids"], len(x))), pa.array(z.ravel())],
                                                 [*names, "latent_id", "act"])

    schema = T.StructType([*[df.schema[n] for n in names], T.StructField("latent_id", T.LongType()),
                           T.StructField("act", T.DoubleType())])
    return _source(df, names, vec_col).mapInArrow(run, schema)


def topk_long(pre: DataFrame, k: int, id_col="id") -> DataFrame:
    """Relational top-k over long-form activations (E3): rank per vector by
    act desc, latent_id asc. Each group holds one vector's L activations."""
    w = Window.partitionBy(*_names(id_col)).orderBy(F.col("act").desc(), F.col("latent_id"))
    return pre.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


# ------------------------------------------------------------------ decode

def with_entries(codes: DataFrame, dictionary: SparseDictionary, id_col="id",
                 budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Codes joined with their entries' decoder rows: broadcast under the
    budget, else salted, as a few entries may hold most codes."""
    w = dictionary.entries.select("latent_id", "w_dec")
    if dictionary.entry_bytes() // 2 <= budget:
        return codes.join(F.broadcast(w), "latent_id")
    salted = w.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.xxhash64(*_names(id_col)), F.lit(SALTS)).cast("int")
    return codes.withColumn("_salt", own).join(salted, ["latent_id", "_salt"]).drop("_salt")


def decode(codes: DataFrame, dictionary: SparseDictionary, id_col="id", out: str = "recon",
           with_bias: bool = True, budget: int = BROADCAST_BUDGET) -> DataFrame:
    """``sum(act * w_dec[latent]) + b_dec`` per vector (E5) as a join + aggregate.

    The group per vector holds its k codes, so the array sum is bounded by k.
    """
    d, names = dictionary.d, _names(id_col)
    j = with_entries(codes, dictionary, id_col, budget)
    scaled = F.transform("w_dec", lambda v: v * F.col("act"))
    zero = F.array_repeat(F.lit(0.0), d)
    summed = F.aggregate(F.collect_list(scaled), zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    agg = j.groupBy(*names).agg(summed.alias("_s"))
    if with_bias:
        bias = F.array(*[F.lit(float(b)) for b in dictionary.b_dec])
        return agg.select(*names, F.zip_with("_s", bias, lambda a, b: a + b).alias(out))
    return agg.select(*names, F.col("_s").alias(out))


def count_dead(dictionary: SparseDictionary, dead) -> int:
    """How many of the dictionary's entries are among ``dead``."""
    if dead is None:
        return 0
    ids = dead_ids(dictionary.entries.sparkSession, dead)
    return dictionary.entries.select("latent_id").join(ids, "latent_id", "left_semi").count()


def forward(df: DataFrame, dictionary: SparseDictionary, id_col="id", vec_col: str = "vec",
            target_col: str | None = None, k: int | None = None, dead=None, multi: int | None = None,
            skip: bool = True, codes: bool = False, budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Encode and decode (E6, E7) in one pass per Arrow batch: ``(id columns,
    target, recon)``; transcoders decode towards ``target_col``.

    ``dead`` adds ``e_hat``, the decoding (with ``b_dec``) of the strongest
    ``min(d // 2, n_dead)`` dead entries (E11). ``multi`` adds ``multi``, a
    reconstruction from that many entries without skip term (E12). ``codes``
    adds ``ids`` and ``acts``, each vector's codes. ``skip`` turns the skip
    term of ``recon`` off. Rows never leave their partition.
    """
    names, d = _names(id_col), dictionary.d
    k, total, activation = dictionary.k if k is None else k, dictionary.num_latents, dictionary.activation
    blocks = dictionary.stored(budget, dead)
    n_dead = count_dead(dictionary, dead)
    matrix = dictionary.skip_matrix() if skip else None
    extra = df.sparkSession.sparkContext.broadcast(matrix) if matrix is not None else None
    widest = min(total, max(1, budget // (max(d, 1) * 16)))
    bias = np.asarray(dictionary.b_dec, dtype=np.float64)
    with_dead = dead is not None

    def run(batches):
        for b, x in _slices(batches, blocks, d, widest):
            act, ids = selected(x, blocks, k, activation, total)
            recon = rebuilt(act, ids, blocks, bias)
            if extra is not None:
                recon = recon + x @ extra.value.T
            out = {**{n: b.column(n) for n in names}, "target": b.column("_target"), "recon": _lists(recon)}
            if with_dead:
                out["e_hat"] = _lists(rebuilt(*strongest(x, blocks, min(d // 2, n_dead), dead=True), blocks, bias))
            if multi is not None:
                out["multi"] = _lists(rebuilt(*selected(x, blocks, multi, activation, total), blocks, bias))
            if codes:
                out["ids"], out["acts"] = _lists(ids), _lists(act)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    vector = T.ArrayType(T.DoubleType())
    added = ["target", "recon"] + ["e_hat"] * (dead is not None) + ["multi"] * (multi is not None)
    schema = T.StructType([*[df.schema[n] for n in names], *[T.StructField(n, vector) for n in added],
                           *([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("acts", vector)] if codes else [])])
    return _source(df, names, vec_col, as_double_array(target_col or vec_col).alias("_target")).mapInArrow(run, schema)


def transform(df: DataFrame, dictionary: SparseDictionary, vec_col: str = "vec", enabled: bool = True,
              budget: int = BROADCAST_BUDGET) -> DataFrame:
    """``df`` with every vector replaced by its reconstruction (E8); all other
    columns and the order of columns stay. ``enabled=False`` changes nothing."""
    if not enabled:
        return df
    others = [n for n in df.columns if n != vec_col]
    out = forward(df, dictionary, others, vec_col, budget=budget)
    return out.select(*[F.col("recon").alias(n) if n == vec_col else F.col(n) for n in df.columns])


def pair(inputs: DataFrame, targets: DataFrame, keys, vec_col: str = "vec", target_col: str = "target") -> DataFrame:
    """Inputs with their targets (E7): an equi-join on ``keys``. An input
    without a target keeps a null one, and has no part in losses."""
    keys = _names(keys)
    return inputs.join(targets.select(*keys, F.col(vec_col).alias(target_col)), keys, "left")


# ------------------------------------------------------------------ losses

def sq_error(y, y_hat) -> Column:
    return F.aggregate(F.zip_with(c(y), c(y_hat), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def _moments_of(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, ...]:
    """Per position of the vectors ``names[0]``: count, mean, summed squared
    deviation; and per further column its summed squared distance from them."""
    y, *others = (batch.column(n) for n in names)
    sizes = y.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = int(sizes.max()) if len(sizes) else 0
    flat, known = _flat(y)
    n = np.bincount(pos[known], minlength=width).astype(np.float64)
    mean = np.bincount(pos[known], flat[known], width) / np.maximum(n, 1)
    off = np.bincount(pos[known], (flat[known] - mean[pos[known]]) ** 2, width)
    errors = []
    for x in others:
        other, both = _flat(x)
        if len(other) != len(flat):
            raise ValueError(f"vectors of different lengths: {names}")
        both = both & known
        errors.append(float(((flat[both] - other[both]) ** 2).sum()))
    return n, mean, off, np.asarray(errors)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = column.flatten()
    return np.asarray(values.to_numpy(zero_copy_only=False), np.float64), np.asarray(values.is_valid())


def _met(a: tuple, b: tuple) -> tuple:
    """Moments of two sets of rows from those of each (Chan's formula)."""
    width = max(len(a[0]), len(b[0]))
    (n, mean, off), (m, other, more) = ([np.pad(v, (0, width - len(v))) for v in x[:3]] for x in (a, b))
    total = n + m
    step = other - mean
    share = m / np.maximum(total, 1)
    return total, mean + step * share, off + more + step * step * n * share, a[3] + b[3]


def vector_moments(df: DataFrame, names: list[str], by=None) -> DataFrame:
    """Per ``by`` group ``(n, mean, off: array<double>, errors: array<double>)``
    of the vectors ``names[0]``, their squared distances from the other columns
    summed. Each task merges its batches into one row a group; rows meet in a
    tree (salted by task, then by group), one group in memory at a time. Rows
    in which a column is null are left out."""
    by = [by] if isinstance(by, str) else list(by or [])
    x = df.select(*by, *[as_double_array(n).alias(f"_v{i}") for i, n in enumerate(names)])
    columns = [f"_v{i}" for i in range(len(names))]
    for n in columns:
        x = x.where(F.col(n).isNotNull())
    vector = T.ArrayType(T.DoubleType())
    fields = ["n", "mean", "off", "errors"]
    schema = T.StructType([*[x.schema[n] for n in by], *[T.StructField(f, vector) for f in fields]])

    def row(keys: pa.RecordBatch | None, held: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*([keys.column(n) for n in by] if keys is not None else []),
                                           *[pa.array([v], pa.list_(pa.float64())) for v in held]], [*by, *fields])

    def runs(batches, moments):
        """Merge consecutive rows of equal keys."""
        keys = held = None
        for b in batches:
            if not len(b):
                continue
            own = pa.RecordBatch.from_arrays([b.column(n) for n in by], by) if by else None
            codes = pa.StructArray.from_arrays(own.columns, by).to_pylist() if by else [()] * len(b)
            start = 0
            for end in [i for i in range(1, len(b)) if codes[i] != codes[i - 1]] + [len(b)]:
                got = moments(b.slice(start, end - start))
                if held is not None and (not by or keys.to_pylist()[0] == codes[start]):
                    held = _met(held, got)
                else:
                    if held is not None:
                        yield row(keys, held)
                    keys, held = own.slice(start, 1) if by else None, got
                start = end
        if held is not None:
            yield row(keys, held)

    def first(batches):
        return runs(batches, lambda b: _moments_of(b, columns))

    def again(batches):
        def moments(b):
            got = [tuple(np.asarray(b.column(f)[i].values) for f in fields) for i in range(len(b))]
            out = got[0]
            for g in got[1:]:
                out = _met(out, g)
            return out
        return runs(batches, moments)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = (x.sortWithinPartitions(*by) if by else x).mapInArrow(first, schema)
    salt = F.pmod(F.spark_partition_id(), F.lit(n)).alias("_salt")
    some = parts.select("*", salt).repartition(n, *by, "_salt").drop("_salt")
    some = (some.sortWithinPartitions(*by) if by else some).mapInArrow(again, schema)
    met = some.repartition(n, *by).sortWithinPartitions(*by) if by else some.repartition(1)
    return met.mapInArrow(again, schema)


def fvu(df: DataFrame, y: str = "target", y_hat: str = "recon", by=None) -> DataFrame:
    """Fraction of variance unexplained per ``by`` group (E10): the squared
    error over the variance of ``y`` summed over positions, one pass."""
    by = [by] if isinstance(by, str) else list(by or [])
    m = vector_moments(df, [y, y_hat], by)
    return m.select(*by, F.col("errors")[0].alias("sse"), _total("off").alias("total_variance"),
                    _total("n").cast("bigint").alias("n_elements")).withColumn("fvu", F.col("sse") / F.col("total_variance"))


def _total(name: str) -> Column:
    return F.aggregate(name, F.lit(0.0), lambda a, b: a + b)


def recon_mse(df: DataFrame, y: str = "target", y_hat: str = "recon") -> DataFrame:
    """Mean squared error over all elements."""
    return df.agg((F.sum(sq_error(y, y_hat)) / F.sum(F.size(c(y)))).alias("mse"))


def auxk_loss(df: DataFrame, dictionary: SparseDictionary, dead, id_col="id", vec_col: str = "vec",
              budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Auxiliary loss on dead entries (E11): one row ``(auxk, n_dead)``; 0 when
    nothing is dead.

    The strongest dead entries should reconstruct what the others leave over:
    the squared error of ``e_hat`` against ``target - recon``, relative to the
    total variance, weighted by the dead share of half the width (at most 1).
    """
    return losses(df, dictionary, id_col, vec_col, dead=dead, budget=budget).select("auxk", "n_dead")


def losses(df: DataFrame, dictionary: SparseDictionary, id_col="id", vec_col: str = "vec", target_col: str | None = None,
           dead=None, multi: int | None = None, auxk_alpha: float = 0.0, budget: int = BROADCAST_BUDGET) -> DataFrame:
    """One row ``(fvu, auxk, multi_fvu, total, n_dead)`` from one pass over the
    vectors (E13): ``total = fvu + auxk_alpha * auxk + multi_fvu / 8``."""
    fw = forward(df, dictionary, id_col, vec_col, target_col, dead=dead, multi=multi, budget=budget)
    half, n_dead = dictionary.d // 2, count_dead(dictionary, dead)
    # squared distances from the target: of recon, of recon + e_hat, of multi
    fw = fw.where(F.col("target").isNotNull())
    names = ["target", "recon"]
    if n_dead:
        fw = fw.withColumn("_both", F.zip_with("recon", "e_hat", lambda a, b: a + b))
        names.append("_both")
    if multi is not None:
        names.append("multi")
    m = vector_moments(fw, names)
    at = lambda name: F.col("errors")[names.index(name) - 1] if name in names else F.lit(0.0)
    t = m.select(_total("off").alias("tv"), at("recon").alias("se"), at("_both").alias("sa"), at("multi").alias("sm"))
    # one row also without vectors, as of any aggregate
    t = t.agg(*[F.sum(n).alias(n) for n in ("tv", "se", "sa", "sm")])
    weight = min(n_dead / half, 1.0) if half else 0.0
    # without rows there is no variance, and nothing dead costs nothing
    aux_loss = F.lit(weight) * F.col("sa") / F.col("tv") if n_dead else F.lit(0.0)
    return t.select((F.col("se") / F.col("tv")).alias("fvu"), aux_loss.alias("auxk"),
                    (F.col("sm") / F.col("tv")).alias("multi_fvu"), F.lit(n_dead).cast("bigint").alias("n_dead")).withColumn(
        "total", F.col("fvu") + F.lit(auxk_alpha) * F.col("auxk") + F.col("multi_fvu") / 8)


# ------------------------------------------------------------------ row-wise vector ops

def normalize_rows(df: DataFrame, col: str, eps: float = F32_EPS, out: str | None = None) -> DataFrame:
    """``w / (||w|| + eps)`` per row."""
    w = as_double_array(col)
    return df.withColumn(out or col, vscale(w, F.lit(1.0) / (l2_norm(w) + F.lit(eps))))


def remove_parallel(df: DataFrame, g: str, w: str, out: str | None = None) -> DataFrame:
    """``g - (g . w) w`` per row."""
    gd, wd = as_double_array(g), as_double_array(w)
    return df.withColumn(out or g, vsub(gd, vscale(wd, dot(gd, wd))))


def mean_vector(df: DataFrame, vec: str, by=None, out: str = "mean") -> DataFrame:
    """Per-dimension mean per group (E16) and its number of rows."""
    by = [by] if isinstance(by, str) else list(by or [])
    return vector_moments(df, [vec], by).select(*by, F.col("mean").alias(out),
                                                F.array_max("n").cast("bigint").alias("n_rows"))


def flatten_vectors(df: DataFrame, seq_col: str, key: str = "sample_id",
                    out: str = "vec") -> DataFrame:
    """Sequence of vectors per sample to one row per position."""
    return df.select(key, F.posexplode(seq_col).alias("pos", out))


# ------------------------------------------------------------------ per-entry statistics

def latent_usage(codes: DataFrame) -> DataFrame:
    """Entry usage histogram ordered by count desc with running start offsets.

    The count per entry is a partial aggregation (hot entries combine
    map-side); offsets are two-level running sums over range partitions.
    """
    from tessera.operators.positions import prefix_sum
    cnt = codes.groupBy("latent_id").agg(F.count(F.lit(1)).alias("n_codes"))
    return prefix_sum(cnt, [F.col("n_codes").desc(), F.col("latent_id")], "n_codes", out="start", inclusive=False).select(
        "latent_id", "n_codes", F.col("start").cast("bigint").alias("start"))


def latent_index(codes: DataFrame, id_col: str = "id") -> DataFrame:
    """Inverted index (E17) as a table clustered by entry: one row per
    ``(latent_id, id)`` with its ``slot`` in the entry's posting list.

    Rows are laid out by ``(latent_id, id)``, so a hot entry spreads over many
    pieces, and numbered within their entry as they are written. Only the
    first entry of a piece can begin in earlier ones: their rows of it are
    carried over from one summary row a piece (broadcast, at most as many as
    partitions). No join is on the entry. Codes without an entry are left out.
    """
    from tessera.operators.positions import laid_out
    narrow = codes.where("latent_id is not null").select("latent_id", id_col, F.lit(1).alias("_one"))
    laid = laid_out(narrow, ["latent_id", id_col], "_one", run_of="latent_id")
    pieces = laid.groupBy("_piece").agg(F.min("latent_id").alias("_first"), F.max("latent_id").alias("_last"),
                                        (F.max_by("_place", "_row") + 1).alias("_tail"))
    upto = F.sum("_tail").over(Window.partitionBy("_last").orderBy("_piece"))
    before = Window.orderBy("_piece")
    pieces = pieces.withColumn("_upto", upto).select("_piece", "_first", F.when(
        F.lag("_last").over(before) == F.col("_first"), F.lag("_upto").over(before)).otherwise(0).alias("_carry"))
    slot = F.col("_place") + F.when(F.col("latent_id") == F.col("_first"), F.col("_carry")).otherwise(0)
    return laid.join(F.broadcast(pieces), "_piece").select("latent_id", id_col, slot.alias("slot"))


def _sums_by_entry(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, and the sums of their rows."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
    return ids[order][first], np.add.reduceat(rows[order], first, axis=0)


def latent_grad(codes: DataFrame, grad: DataFrame, d: int, id_col: str = "id",
                grad_col: str = "grad") -> DataFrame:
    """Per entry ``sum(act * grad_row)`` (E17, decoder-weight gradient).

    Each Arrow batch is summed per entry first (one array for each entry it
    touches, so a hot entry sends one row a batch), then the sums meet by entry.
    """
    j = codes.join(grad.select(id_col, as_double_array(grad_col).alias("_g")), id_col).select("latent_id", "act", "_g")
    schema = "latent_id bigint, grad array<double>"

    def partial(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                rows = np.asarray(part.column("act"))[:, None] * _matrix(part.column("_g"), d)
                ids, sums = _sums_by_entry(np.asarray(part.column("latent_id")), rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids), _lists(sums)], ["latent_id", "grad"])

    def total(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                ids, sums = _sums_by_entry(np.asarray(b.column("latent_id")), _matrix(b.column("grad"), d))
                for i, row in zip(ids.tolist(), sums):
                    held[i] = held[i] + row if i in held else row
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), _lists(np.stack(list(held.values())))],
                                             ["latent_id", "grad"])

    n = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return j.mapInArrow(partial, schema).repartition(n, "latent_id").mapInArrow(total, schema)


def code_grad(codes: DataFrame, grad: DataFrame, dictionary: SparseDictionary, id_col: str = "id",
              grad_col: str = "grad", budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Per code ``grad_row . w_dec[latent]`` (E17, activation gradient)."""
    j = with_entries(codes.join(grad.select(id_col, as_double_array(grad_col).alias("_g")), id_col), dictionary, id_col, budget)
    return j.select(id_col, "latent_id", dot("_g", "w_dec").alias("grad_act"))
