"""Fitting a k-sparse dictionary (E19), warm start / resume (E20), and
several groups and seeds in one run (E21).

Execution
---------
Parameters are tables with one row per run and entry (weights and the tokens
since the entry last fired); a run is one group's fit from one seed, and
several runs take their steps together: a step is the same number of jobs
whatever the number of runs. The driver holds a decoder bias and a row of
metrics for each run, and never sees entries.

The input is indexed once (D13), cut into mini-batches of ``batch_size`` rows
of a group (D11) and written range-sorted by batch to the shared checkpoint
folder, so each step reads only its batches.

A step's parameters lie in a folder by run and block of entries. Every task
runs the forward pass over its Arrow batches, opening block after block there
(as in ``tessera.operators.sparse``), and emits one partial gradient row for
each entry that a slice of its rows touched; these are added up per entry after
a shuffle. An equi-join of the sums with the parameter table then makes the
next table: sign update, unit norms, counters. Choose ``batch_size`` so that a
step is worth its jobs (a full batch is fine).

Loss: FVU of the top-k reconstruction (``auxk_alpha`` 0 and no multi-top-k,
the configured defaults). Per step: gradient components along the decoder
rows are removed, ``w -= lr * sign(g)``, decoder rows are brought to unit
norm, counters advance. ``b_dec`` starts as the first batch's mean; a warm
start keeps the stored ``b_dec`` and, if given, the stored counters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import dot, l2_norm, vscale, vsub
from tessera.operators.positions import with_index
from tessera.operators.sparse import (
    BROADCAST_BUDGET,
    F32_EPS,
    SparseDictionary,
    StoredBlock,
    _lists,
    _matrix,
    _slices,
    block_of,
    held_one_by_one,
    mean_vector,
    rebuilt,
    strongest,
    write_blocks,
)
from tessera.session import scratch_path

SUM_SCHEMA = "run int, latent_id bigint, g_be double, g_we array<double>, g_wd array<double>"
METRICS_SCHEMA = "step long, k long, fvu double, dead_pct double, n_rows long"

# Rows of sums that belong to no entry: (error, gradient of b_dec, sum of x) and (rows, 0, sum of x^2).
BIAS_ROW, ROWS_ROW = -1, -2


def default_lr(num_latents: int) -> float:
    """Sign-update learning rate scaled by dictionary size (fixed rule: 5e-3 / sqrt(L / 2^14))."""
    return 5e-3 / (num_latents / 2 ** 14) ** 0.5


def annealed_k(step: int, first: int, last: int, over: int) -> int:
    """k on the straight line from ``first`` at step 0 to ``last`` at step
    ``over`` and after it, rounded half to even."""
    done = min(step, over) / over if over > 0 else 1.0
    return round(first + (last - first) * done)


@dataclass
class FitResult:
    dictionary: SparseDictionary
    metrics: DataFrame          # one row per step
    since_fired: DataFrame      # (latent_id, tokens_since_fired) after the last step


@dataclass
class _Run:
    """One fit among those that step together."""
    index: int
    group: int
    seed: int
    blocks: list
    bias: np.ndarray
    k: int


def _rows_of(run: int, ids, g_be, g_we, g_wd):
    ids = np.asarray(ids, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(ids), run), pa.int32()), pa.array(ids), pa.array(np.asarray(g_be, np.float64)),
         _lists(g_we), _lists(g_wd)], ["run", "latent_id", "g_be", "g_we", "g_wd"])


class _Totals:
    """What a task adds up for a run: error, rows, and sums by position."""

    def __init__(self, d: int):
        self.error, self.n, self.g_bias, self.sums, self.squares = 0.0, 0, np.zeros(d), np.zeros(d), np.zeros(d)


def _slice_sums(x: np.ndarray, run: _Run, transcode: bool, held: _Totals):
    """Gradient sums of a slice of rows: for each block, one row per touched entry."""
    act, ids = strongest(x, run.blocks, run.k)
    off = rebuilt(act, ids, run.blocks, run.bias) - x
    g = 2.0 * off
    held.error, held.n = held.error + float((off * off).sum()), held.n + len(x)
    held.g_bias, held.sums, held.squares = held.g_bias + g.sum(0), held.sums + x.sum(0), held.squares + (x * x).sum(0)
    into = x if transcode else x - run.bias
    for p in held_one_by_one(run.blocks):
        pos = np.minimum(np.searchsorted(p["ids"], ids), max(len(p["ids"]) - 1, 0))
        here, col = np.nonzero(p["ids"][pos] == ids) if len(p["ids"]) else (np.empty(0, int),) * 2
        if not len(here):
            continue
        entry, a = pos[here, col], act[here, col]
        slope = (g[here] * p["w_dec"][entry]).sum(1) * (a > 0)
        if not transcode:
            held.g_bias = held.g_bias - slope @ p["w_enc"][entry]
        order = np.argsort(entry, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(entry[order]) > 0])
        total = lambda v: np.add.reduceat(v[order], first, axis=0)
        yield _rows_of(run.index, p["ids"][entry[order][first]], total(slope), total(slope[:, None] * into[here]),
                       total(a[:, None] * g[here]))


def _partial_sums(runs: list[_Run], d: int, transcode: bool, widest: int):
    """Gradient sums of a task's rows for every run of their group."""
    def run(batches):
        held = {r.index: _Totals(d) for r in runs}
        most = max((r.blocks for r in runs), key=len)
        for part, x in _slices(batches, most, d, widest):
            group = np.asarray(part.column("_group"))
            for r in runs:
                mine = x[group == r.group]
                if len(mine):
                    yield from _slice_sums(mine, r, transcode, held[r.index])
        for i, t in held.items():
            if t.n:
                yield _rows_of(i, [BIAS_ROW, ROWS_ROW], [t.error, t.n], np.stack([t.g_bias, np.zeros(d)]),
                               np.stack([t.sums, t.squares]))
    return run


def _added(d: int):
    """Sums per run and entry of the rows of one shuffle partition."""
    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            if not len(b):
                continue
            runs, ids = np.asarray(b.column("run")), np.asarray(b.column("latent_id"))
            both = np.concatenate([np.asarray(b.column("g_be"))[:, None], _matrix(b.column("g_we"), d),
                                   _matrix(b.column("g_wd"), d)], axis=1)
            order = np.lexsort((ids, runs))
            first = np.flatnonzero(np.r_[True, (np.diff(ids[order]) != 0) | (np.diff(runs[order]) != 0)])
            keys = zip(runs[order][first].tolist(), ids[order][first].tolist(), strict=True)
            for key, row in zip(keys, np.add.reduceat(both[order], first, axis=0), strict=True):
                held[key] = held[key] + row if key in held else row
        if held:
            rows, keys = np.stack(list(held.values())), np.asarray(list(held), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0], pa.int32()), pa.array(keys[:, 1]), pa.array(rows[:, 0]), _lists(rows[:, 1:d + 1]),
                 _lists(rows[:, d + 1:])], ["run", "latent_id", "g_be", "g_we", "g_wd"])
    return run


def _sums(rows: DataFrame, runs: list[_Run], d: int, transcode: bool, widest: int) -> DataFrame:
    """Summed gradients over ``rows`` (``_group``, ``vec``) for all runs."""
    x = rows.where(F.col("vec").isNotNull()).select("_group", F.col("vec").cast("array<double>").alias("_vec"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (x.mapInArrow(_partial_sums(runs, d, transcode, widest), SUM_SCHEMA)
            .repartition(n, "run", "latent_id").mapInArrow(_added(d), SUM_SCHEMA))


def _widest(num_latents: int, d: int, budget: int) -> int:
    return min(num_latents, max(1, budget // (max(d, 1) * 16)))


def gradient(rows: DataFrame, dictionary: SparseDictionary, k: int, budget: int = BROADCAST_BUDGET) -> DataFrame:
    """Sums of the squared error's gradient over ``rows`` (column ``vec``): a
    row per touched entry, and the two rows of totals."""
    run = _Run(0, 0, 0, dictionary.stored(budget), np.asarray(dictionary.b_dec, np.float64), k)
    return _sums(rows.withColumn("_group", F.lit(0)), [run], dictionary.d, dictionary.transcode,
                 _widest(dictionary.num_latents, dictionary.d, budget)).drop("run")


def _unit(w):
    return vscale(w, F.lit(1.0) / (l2_norm(w) + F.lit(F32_EPS)))


def _signed(w, g, lr: float):
    return F.zip_with(w, g, lambda a, b: a - F.lit(lr) * F.signum(b))


def updated(params: DataFrame, sums: DataFrame, d: int, lr: float, n_rows, transcode: bool) -> DataFrame:
    """The next parameter table: an equi-join of entries with their gradient
    sums. Untouched entries keep their weights, and their counters advance."""
    j = params.join(sums.where(F.col("latent_id") >= 0), ["run", "latent_id"], "left")
    none = F.array_repeat(F.lit(0.0), d)
    g_wd = F.coalesce("g_wd", none)
    j = j.withColumn("g_wd", g_wd).withColumn("_along", F.lit(0.0) if transcode else dot("g_wd", "w_dec"))
    j = j.withColumn("w_dec", _signed("w_dec", F.col("g_wd") if transcode else vsub(F.col("g_wd"), vscale("w_dec", "_along")), lr))
    return j.select("run", "block", "latent_id", _signed("w_enc", F.coalesce("g_we", none), lr).alias("w_enc"),
                    (F.col("b_enc") - F.lit(lr) * F.signum(F.coalesce("g_be", F.lit(0.0)))).alias("b_enc"),
                    (F.col("w_dec") if transcode else _unit(F.col("w_dec"))).alias("w_dec"),
                    F.when(F.col("g_we").isNotNull(), F.lit(0).cast("bigint"))
                    .otherwise(F.col("tokens_since_fired") + n_rows).alias("tokens_since_fired"))


class SparseDictionaryEstimator:
    """``SparseDictionaryEstimator(num_latents, k).fit(df)``."""

    def __init__(self, num_latents: int, k: int, batch_size: int = 65536, lr: float | None = None,
                 k_decay_steps: int = 0, dead_threshold: int = 10_000_000, transcode: bool = False,
                 seed: int = 0, epochs: int = 1):
        self.num_latents, self.k, self.batch_size = num_latents, k, batch_size
        self.lr = lr or default_lr(num_latents)
        self.k_decay_steps, self.dead_threshold = k_decay_steps, dead_threshold
        self.transcode, self.seed, self.epochs = transcode, seed, epochs

    # ---------------------------------------------------------------- data
    def _prepare(self, df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, dict[int, int], int]:
        """Rows (_group, batch, id, vec), the number of batches of each group, and the width."""
        spark = df.sparkSession
        src = df.select("_group", F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
        sizes = {r["_group"]: r["n"] for r in src.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            raise ValueError("no rows to fit")
        # index the ids only, then attach the vectors with an equi-join on the id
        idx, first, at = with_index(src.select("_group", "id"), ["_group", "id"], "_i"), {}, 0
        for g in sorted(sizes):
            first[g], at = at, at + sizes[g]
        own = F.col("_i") - _of_group(first)
        x = src.join(idx, ["_group", "id"]).withColumn("batch", F.floor(own / self.batch_size).cast("bigint"))
        path = scratch_path(spark, "fit-input")
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        (x.select("_group", "batch", "id", "vec").repartitionByRange(n_parts, "_group", "batch", "id")
         .sortWithinPartitions("_group", "batch", "id").write.mode("overwrite").parquet(path))
        data = spark.read.parquet(path)
        d = data.agg(F.max(F.size("vec"))).first()[0]
        return data, {g: -(-n // self.batch_size) for g, n in sizes.items()}, int(d)

    # ---------------------------------------------------------------- params
    def _fresh(self, spark, d: int, seeds: list[int]) -> DataFrame:
        """First weights of each run: even in +-1/sqrt(d), from a hash of seed, entry and position."""
        steps = 1 << 52
        share = lambda i: F.pmod(F.xxhash64(F.col("r.seed"), F.col("id"), i), F.lit(steps)) / F.lit(float(steps))
        w = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: (share(i) * 2 - 1) / F.lit(d ** 0.5))
        runs = F.array(*[F.struct(F.lit(i).alias("run"), F.lit(seed).alias("seed")) for i, seed in enumerate(seeds)])
        t = spark.range(self.num_latents).select("id", F.explode(runs).alias("r")).select(
            F.col("r.run").alias("run"), F.col("id").alias("latent_id"), w.alias("w_enc"), F.lit(0.0).alias("b_enc"))
        return t.withColumn("w_dec", F.array_repeat(F.lit(0.0), d) if self.transcode else F.col("w_enc"))

    def _stored(self, table: DataFrame, n: int = 0) -> tuple[str, DataFrame]:
        """Written to the scratch folder, parameters (``n`` blocks) by run and block."""
        path = scratch_path(table.sparkSession, "fit-params" if n else "fit-sums")
        if n:
            write_blocks(table, path, ["run", "block"], n)
        else:
            table.write.mode("overwrite").parquet(path)
        return path, table.sparkSession.read.schema(table.schema).parquet(path)

    # ---------------------------------------------------------------- fit
    def fit(self, df: DataFrame, id_col: str = "id", vec_col: str = "vec", init: SparseDictionary | None = None,
            init_since: DataFrame | None = None, start_step: int = 0, stop_step: int | None = None,
            save_path: str | None = None, hookpoint: str = "default", save_every: int = 1000) -> FitResult:
        """Fit over ``epochs`` passes of mini-batches.

        ``init`` (and ``init_since``, the counters) resume an earlier fit at
        ``start_step``; ``stop_step`` ends this one before that step. With
        ``save_path``, the dictionary is stored (step checkpoint and
        ``latest``) whenever a step with ``(step + 1) % save_every == 0`` or
        the final step has a loss strictly below every earlier saved one.
        """
        best = float("inf")

        def save(step: int, steps: int, fvu: float, dictionary: SparseDictionary) -> None:
            nonlocal best
            if save_path and ((step + 1) % save_every == 0 or step == steps - 1) and fvu < best:
                from tessera.sources.dictionary_store import write_dictionary
                best = fvu
                write_dictionary(dictionary, save_path, hookpoint, step + 1)

        rows, params, bias = self.fit_runs(df.withColumn("_group", F.lit(0)), [(0, self.seed)], id_col, vec_col, init,
                                           init_since, start_step, stop_step, save)
        mine = params.where("run = 0")
        return FitResult(SparseDictionary(mine.select("latent_id", "w_enc", "b_enc", "w_dec"), bias[0].tolist(), self.k,
                                          self.transcode),
                         df.sparkSession.createDataFrame([r[1:] for r in rows], METRICS_SCHEMA),
                         mine.select("latent_id", "tokens_since_fired"))

    def fit_runs(self, df: DataFrame, runs: list[tuple[int, int]], id_col: str, vec_col: str,
                 init: SparseDictionary | None = None, init_since: DataFrame | None = None, start_step: int = 0,
                 stop_step: int | None = None, save=None, budget: int = BROADCAST_BUDGET):
        """All ``runs`` (``_group`` of the rows, seed) step by step together.
        Returns metric rows (run, step, k, fvu, dead, rows), the parameter
        table (run, block, latent_id, ...) and each run's decoder bias."""
        spark = df.sparkSession
        data, n_batches, d = self._prepare(df, id_col, vec_col)
        if init is not None and init.num_latents != self.num_latents:
            raise ValueError(f"the initial dictionary has {init.num_latents} entries, the estimator {self.num_latents}")
        if init is None:
            params = self._fresh(spark, d, [seed for _, seed in runs])
            each = max(1, budget // (max(d, 1) * 16))
            starts = list(range(0, self.num_latents, each))
        else:
            every = F.explode(F.array(*[F.lit(i) for i in range(len(runs))]))
            params = init.entries.select(every.alias("run"), "latent_id", "w_enc", "b_enc", "w_dec")
            starts = [lo for lo, _ in init.blocks(budget)]
        if init_since is not None:
            params = params.join(init_since.select("latent_id", "tokens_since_fired"), "latent_id", "left").withColumn(
                "tokens_since_fired", F.coalesce("tokens_since_fired", F.lit(0)))
        else:
            params = params.withColumn("tokens_since_fired", F.lit(0).cast("bigint"))
        if not self.transcode:
            params = params.withColumn("w_dec", _unit(F.col("w_dec")))
        params = params.select("run", block_of(starts).alias("block"), "latent_id", "w_enc", "b_enc", "w_dec", "tokens_since_fired")
        n_blocks = len(starts) * len(runs)
        path, params = self._stored(params, n_blocks)
        if init is not None:
            bias = [np.asarray(init.b_dec, np.float64) for _ in runs]
        elif self.transcode:
            bias = [np.zeros(d) for _ in runs]
        else:  # d values for each group
            means = {r["_group"]: r["mean"] for r in mean_vector(data.where("batch = 0"), "vec", "_group").collect()}
            bias = [np.asarray(means[g]) for g, _ in runs]
        metrics, first_k = [], min(self.num_latents, 10 * d)
        steps = {g: n * self.epochs for g, n in n_batches.items()}
        end = max(steps.values())
        for step in range(start_step, end if stop_step is None else min(end, stop_step)):
            k = annealed_k(step, first_k, self.k, self.k_decay_steps) if self.k_decay_steps else self.k
            now = [_Run(i, g, seed, [StoredBlock(f"{path}/run={i}/block={b}", d, bias[i].tolist(), self.transcode)
                                     for b in range(len(starts))], bias[i], k)
                   for i, (g, seed) in enumerate(runs) if step < steps[g]]
            wanted = {r.group: step % n_batches[r.group] for r in now}
            batch = data.where(F.col("_group").isin(list(wanted)) & (F.col("batch") == _of_group(wanted)))
            _, sums = self._stored(_sums(batch, now, d, self.transcode, _widest(self.num_latents, d, budget)))
            # two rows for each run
            told = {(r["run"], r["latent_id"]): r for r in sums.where(F.col("latent_id") < 0).collect()}
            n_rows = {r.index: int(told[r.index, ROWS_ROW]["g_be"]) for r in now}
            moved = updated(params, sums, d, self.lr, _of_run(n_rows), self.transcode)
            if len(now) < len(runs):  # runs that have ended stay as they are
                ended = ~F.col("run").isin(list(n_rows))
                moved = moved.where(~ended).unionByName(params.where(ended))
            path, params = self._stored(moved, n_blocks)
            dead = {r["run"]: r["x"] for r in params.groupBy("run").agg(
                F.avg((F.col("tokens_since_fired") > self.dead_threshold).cast("double")).alias("x")).collect()}
            for r in now:
                total, tail, n = told[r.index, BIAS_ROW], told[r.index, ROWS_ROW], n_rows[r.index]
                spread = np.asarray(tail["g_wd"]) - np.asarray(total["g_wd"]) ** 2 / n
                fvu = float(total["g_be"] / spread.sum())
                bias[r.index] = bias[r.index] - self.lr * np.sign(total["g_we"])
                metrics.append((r.index, step, k, fvu, float(dead[r.index]), n))
                if save is not None:
                    save(step, steps[r.group], fvu, SparseDictionary(
                        params.where(F.col("run") == r.index).select("latent_id", "w_enc", "b_enc", "w_dec"),
                        bias[r.index].tolist(), self.k, self.transcode))
        return metrics, params, bias


def _choice(name: str, values: dict[int, int]):
    """``values`` by the column ``name`` (a bounded list of groups or runs)."""
    return F.element_at(F.create_map(*[F.lit(int(x)) for kv in values.items() for x in kv]), F.col(name))


def _of_group(values: dict[int, int]):
    return _choice("_group", values)


def _of_run(values: dict[int, int]):
    return _choice("run", values)


def fit_many(df: DataFrame, by: str, seeds, estimator_args: dict, id_col: str = "id",
             vec_col: str = "vec", init: SparseDictionary | None = None) -> DataFrame:
    """Fit one dictionary per ``by`` group and seed (E21); returns the step
    metrics of every run with ``by`` and ``seed`` columns. Groups are model
    modules, so their list is small. All runs share each step's jobs: one pass
    over the step's batches gives the gradients of every run, and one join
    updates all parameters."""
    keys = [r[by] for r in df.select(by).distinct().orderBy(by).collect()]
    group = F.lit(None).cast("int")
    for i, key in enumerate(keys):
        group = F.when(F.col(by).eqNullSafe(F.lit(key)), i).otherwise(group)
    runs = [(i, int(seed)) for i in range(len(keys)) for seed in seeds]
    rows, _, _ = SparseDictionaryEstimator(**estimator_args).fit_runs(
        df.withColumn("_group", group), runs, id_col, vec_col, init)
    kind = df.schema[by].dataType.simpleString()
    return df.sparkSession.createDataFrame([(keys[runs[r[0]][0]], runs[r[0]][1], *r[1:]) for r in rows],
                                           f"{by} {kind}, seed long, {METRICS_SCHEMA}")
