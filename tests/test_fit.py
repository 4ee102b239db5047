"""The estimator's gradient against finite differences, equal results for
any number of blocks, resuming with counters, and that fitting lowers the error."""

import numpy as np
import pytest

from tessera.operators import fit as ft
from tessera.operators import sparse as sp


def sse(p, x):
    z = sp.pre_activations(x, p)
    idx = sp.topk_indices(z, p["k"])
    acts = np.take_along_axis(z, idx, 1)
    y = p["b_dec"] + np.einsum("nk,nkd->nd", acts, p["w_dec"][idx])
    return float(((y - x) ** 2).sum())


@pytest.mark.parametrize("budget", [1 << 30, 12 * 5 * 16 // 4])
def test_gradient_matches_finite_differences(spark, budget):
    rng = np.random.default_rng(0)
    L, d, n = 12, 5, 9
    p = {"w_enc": rng.normal(size=(L, d)), "b_enc": rng.normal(size=L) * 0.1,
         "w_dec": rng.normal(size=(L, d)), "b_dec": rng.normal(size=d) * 0.1, "transcode": False, "k": 3}
    x = rng.normal(size=(n, d))
    entries = spark.createDataFrame([(i, p["w_enc"][i].tolist(), float(p["b_enc"][i]), p["w_dec"][i].tolist()) for i in range(L)],
                                    "latent_id bigint, w_enc array<double>, b_enc double, w_dec array<double>")
    df = spark.createDataFrame([(v.tolist(),) for v in x], "vec array<double>")
    rows = {r["latent_id"]: r for r in ft.gradient(df, sp.SparseDictionary(entries, p["b_dec"].tolist(), 3), 3, budget).collect()}
    assert rows[ft.BIAS_ROW]["g_be"] == pytest.approx(sse(p, x)) and rows[ft.ROWS_ROW]["g_be"] == n
    np.testing.assert_allclose(rows[ft.BIAS_ROW]["g_wd"], x.sum(0))
    np.testing.assert_allclose(rows[ft.ROWS_ROW]["g_wd"], (x * x).sum(0))
    eps = 1e-6

    def slope(name, at):
        q = {**p, name: p[name].copy()}
        q[name][at] += eps
        return (sse(q, x) - sse(p, x)) / eps
    entry_ids = [i for i in rows if i >= 0]
    assert len(entry_ids) > 3
    for l in entry_ids[:4]:
        assert rows[l]["g_be"] == pytest.approx(slope("b_enc", l), rel=1e-3, abs=1e-4)
        for j in range(d):
            assert rows[l]["g_we"][j] == pytest.approx(slope("w_enc", (l, j)), rel=1e-3, abs=1e-4)
            assert rows[l]["g_wd"][j] == pytest.approx(slope("w_dec", (l, j)), rel=1e-3, abs=1e-4)
    for j in range(d):
        assert rows[ft.BIAS_ROW]["g_we"][j] == pytest.approx(slope("b_dec", j), rel=1e-3, abs=1e-4)


def test_annealed_k():
    assert [ft.annealed_k(s, 10, 4, 4) for s in range(6)] == [10, 8, 7, 6, 4, 4]  # 8.5 and 5.5 go to even
    assert ft.annealed_k(0, 10, 4, 0) == 4


def test_resumed_fit_equals_uninterrupted_one(spark):
    x = np.random.default_rng(4).normal(size=(120, 6))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    args = dict(num_latents=32, k=2, batch_size=40, lr=5e-3, dead_threshold=50)
    whole = ft.SparseDictionaryEstimator(**args).fit(df)
    half = ft.SparseDictionaryEstimator(**args).fit(df, stop_step=1)
    rest = ft.SparseDictionaryEstimator(**args).fit(df, init=half.dictionary, init_since=half.since_fired, start_step=1)
    a, b = ({r["step"]: r for r in m.collect()} for m in (whole.metrics, rest.metrics))
    assert sorted(b) == [1, 2] and any(a[s]["dead_pct"] > 0 for s in b)
    for s in b:
        assert b[s]["fvu"] == pytest.approx(a[s]["fvu"], rel=1e-9) and b[s]["dead_pct"] == a[s]["dead_pct"]
    since = [{r["latent_id"]: r["tokens_since_fired"] for r in m.since_fired.collect()} for m in (whole, rest)]
    assert since[0] == since[1]


def test_small_learning_rate_lowers_fvu(spark):
    rng = np.random.default_rng(2)
    basis = rng.normal(size=(6, 10))
    codes = rng.uniform(size=(600, 6)) * (rng.uniform(size=(600, 6)) < 0.4)
    x = codes @ basis + 0.01 * rng.normal(size=(600, 10))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    est = ft.SparseDictionaryEstimator(16, 3, batch_size=100, lr=2e-3, epochs=4)
    m = sorted((r["step"], r["fvu"]) for r in est.fit(df).metrics.collect())
    first, last = np.mean([f for _, f in m[:3]]), np.mean([f for _, f in m[-3:]])
    assert last < first


def test_fit_saves_best_checkpoints_and_resumes(spark, tmp_path):
    from tessera.sources.dictionary_store import read_dictionary
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    est = ft.SparseDictionaryEstimator(8, 2, batch_size=50, lr=1e-3)
    path = str(tmp_path / "dicts")
    res = est.fit(df, save_path=path, hookpoint="layers.3.mlp", save_every=2)
    stored = read_dictionary(spark, path, "layers.3.mlp")
    assert stored.num_latents == 8 and stored.k == 2
    resumed = ft.SparseDictionaryEstimator(8, 2, batch_size=50, lr=1e-3).fit(df, init=stored, start_step=6)
    assert resumed.metrics.count() == 0  # nothing left after the last step
    again = ft.SparseDictionaryEstimator(8, 2, batch_size=50, lr=1e-3).fit(df, init=stored, start_step=4)
    assert [r["step"] for r in again.metrics.orderBy("step").collect()] == [4, 5]


def test_runs_together_equal_runs_alone(spark):
    x = np.random.default_rng(6).normal(size=(150, 5))
    rows = [(i, ["a", "b", None][(i % 5) % 3], x[i].tolist()) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id long, layer string, vec array<double>")
    args = dict(num_latents=24, k=2, batch_size=40, lr=5e-3, dead_threshold=60)
    got = {(r["layer"], r["seed"], r["step"]): r for r in ft.fit_many(df, "layer", [0, 3], args).collect()}
    for layer, seed in (("a", 0), ("a", 3), (None, 3)):
        alone = ft.SparseDictionaryEstimator(seed=seed, **args).fit(df.where(df.layer.eqNullSafe(layer)))
        rows = alone.metrics.collect()
        assert len(rows) == sum(key[:2] == (layer, seed) for key in got)
        for r in rows:
            m = got[layer, seed, r["step"]]
            assert m["fvu"] == pytest.approx(r["fvu"], rel=1e-9)
            assert (m["k"], m["n_rows"], m["dead_pct"]) == (r["k"], r["n_rows"], r["dead_pct"])


def test_a_fit_brings_no_entries_to_the_driver(spark, monkeypatch):
    """Rows that reach the driver in a fit don't depend on the number of entries."""
    from pyspark.sql.classic.dataframe import DataFrame
    x = np.random.default_rng(1).normal(size=(60, 4))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    seen = []
    for name in ("collect", "toArrow", "toPandas", "toLocalIterator", "take"):
        plain = getattr(DataFrame, name)

        def counted(self, *args, _plain=plain, **more):
            out = _plain(self, *args, **more)
            out = out if hasattr(out, "__len__") else list(out)
            seen[-1] += len(out)
            return out
        monkeypatch.setattr(DataFrame, name, counted)
    for entries in (16, 512):
        seen.append(0)
        ft.SparseDictionaryEstimator(entries, 2, batch_size=30, lr=1e-3).fit(df)
    assert seen[0] == seen[1] <= 40


def test_blocks_of_parameters_change_nothing(spark):
    x = np.random.default_rng(9).normal(size=(80, 4))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    est = ft.SparseDictionaryEstimator(20, 2, batch_size=40, lr=5e-3, seed=1)
    src = df.withColumn("_group", ft.F.lit(0))
    one, many = (est.fit_runs(src, [(0, 1)], "id", "vec", budget=b) for b in (1 << 26, 3 * 4 * 16))
    assert many[1].select("block").distinct().count() == 7
    np.testing.assert_allclose([r[3] for r in one[0]], [r[3] for r in many[0]], rtol=1e-9)
    a, b = ({r["latent_id"]: r["w_enc"] for r in t[1].collect()} for t in (one, many))
    for i in a:
        np.testing.assert_allclose(a[i], b[i], rtol=1e-9, atol=1e-12)
