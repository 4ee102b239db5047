"""Sparse coding: the join-based and matrix forms must agree (the reference's
own differential decode test: L 128, k 10, widths 48 and 64)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import sparse as sp


def make_dict(spark, L, d, k, seed=0, b_dec=None):
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(L, d))
    rows = [(i, w[i].tolist(), 0.0, (w[i] / np.linalg.norm(w[i])).tolist()) for i in range(L)]
    e = spark.createDataFrame(rows, "latent_id long, w_enc array<double>, b_enc double, w_dec array<double>")
    return sp.SparseDictionary(e, b_dec if b_dec is not None else [0.0] * d, k), w


@pytest.mark.parametrize("d", [48, 64])
def test_decode_join_equals_numpy(spark, d):
    D, _ = make_dict(spark, 128, d, 10, seed=d)
    rng = np.random.default_rng(1)
    codes = [(s, int(l), float(rng.uniform())) for s in range(2) for l in rng.choice(128, 10, replace=False)]
    cdf = spark.createDataFrame(codes, "id long, latent_id long, act double")
    w = np.array([r["w_dec"] for r in D.entries.orderBy("latent_id").collect()])
    for budget in (sp.BROADCAST_BUDGET, 1):  # broadcast, and salted join
        got = {r["id"]: np.array(r["recon"]) for r in sp.decode(cdf, D, budget=budget).collect()}
        for s in range(2):
            np.testing.assert_allclose(got[s], sum(a * w[l] for i, l, a in codes if i == s), rtol=1e-10, atol=1e-12)


def test_encode_matches_numpy_and_blocks_agree(spark):
    L, d, k = 40, 8, 3
    D, w = make_dict(spark, L, d, k, b_dec=[0.1] * d)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(25, d))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    one = sorted((r["id"], r["latent_id"], round(r["act"], 9)) for r in sp.encode(df, D).collect())
    many = sorted((r["id"], r["latent_id"], round(r["act"], 9)) for r in sp.encode(df, D, budget=L * d * 16 // 5).collect())
    assert len(D.blocks(L * d * 16 // 5)) > 1
    z = np.maximum((x - 0.1) @ w.T, 0)
    want = sorted((i, int(j), round(z[i, j], 9)) for i in range(len(x)) for j in np.argsort(-z[i], kind="stable")[:k])
    assert one == want == many


def test_topk_ties_prefer_lowest_index():
    z = np.array([[1.0, 2.0, 2.0, 2.0, 0.5]])
    assert sp.topk_indices(z, 2).tolist() == [[1, 2]]
    assert sp.topk_indices(np.zeros((1, 5)), 3).tolist() == [[0, 1, 2]]


def test_zero_norm_row_stays_finite(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [3.0, 4.0])], "id long, w array<double>")
    got = {r["id"]: r["w"] for r in sp.normalize_rows(df, "w").collect()}
    assert got[0] == [0.0, 0.0]
    assert got[1] == pytest.approx([0.6, 0.8], abs=1e-6)


def test_auxk_without_dead_entries_is_zero(spark):
    D, _ = make_dict(spark, 8, 4, 2)
    df = spark.createDataFrame([(i, [float(i), 1.0, 0.0, 2.0]) for i in range(5)], "id long, vec array<double>")
    r = sp.auxk_loss(df, D, []).first()
    assert r["auxk"] == 0.0 and r["n_dead"] == 0


@pytest.mark.parametrize("activation", ["topk", "groupmax"])
@pytest.mark.parametrize("skip", [False, True])
def test_one_block_equals_many(spark, activation, skip):
    L, d, k = 24, 6, 3
    D, w = make_dict(spark, L, d, k, seed=9, b_dec=[0.05] * d)
    D.activation = activation
    rng = np.random.default_rng(8)
    m = rng.normal(size=(d, d))
    if skip:
        D.w_skip = spark.createDataFrame([(i, m[i].tolist()) for i in range(d)], "row int, w array<double>")
    x = rng.normal(size=(40, d))
    rows = [(f"s{i // 4}", i % 4, x[i].tolist()) for i in range(len(x))] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "sample string, pos int, vec array<double>")
    small, keys = L * d * 16 // 5, ["sample", "pos"]
    assert len(D.blocks(small)) > 4
    unit = w / np.linalg.norm(w, axis=1, keepdims=True)
    z = np.maximum((x - 0.05) @ w.T, 0)
    for budget in (sp.BROADCAST_BUDGET, small, 1):
        fw = {(r["sample"], r["pos"]): r for r in sp.forward(
            df, D, keys, dead=[0, 3, 6, 9], multi=12, codes=True, budget=budget).collect()}
        assert len(fw) == 40
        codes = {}
        for r in sp.encode(df, D, keys, budget=budget).collect():
            codes.setdefault((r["sample"], r["pos"]), []).append(r["latent_id"])
        for i in range(40):
            r = fw[f"s{i // 4}", i % 4]
            if activation == "topk":
                best, more = np.argsort(-z[i], kind="stable")[:k], np.argsort(-z[i], kind="stable")[:12]
            else:
                best, more = ([g + int(np.argmax(z[i, g:g + n])) for g in range(0, L, n)] for n in (L // k, 2))
            assert sorted(codes[f"s{i // 4}", i % 4]) == sorted(best) == sorted(r["ids"])
            np.testing.assert_allclose(r["recon"], 0.05 + z[i, best] @ unit[best] + (x[i] @ m.T if skip else 0), atol=1e-9)
            np.testing.assert_allclose(r["multi"], 0.05 + z[i, more] @ unit[more], atol=1e-9)
            dead = np.array([0, 3, 6, 9])
            dead = dead[np.argsort(-z[i, dead], kind="stable")[:3]]
            np.testing.assert_allclose(r["e_hat"], 0.05 + z[i, dead] @ unit[dead], atol=1e-9)


def test_losses_do_not_depend_on_the_number_of_blocks(spark):
    L, d = 24, 6
    D, _ = make_dict(spark, L, d, 3, seed=9, b_dec=[0.05] * d)
    x = np.random.default_rng(8).normal(size=(40, d))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    dead = D.entries.where("latent_id % 3 = 0").select("latent_id")
    a, b = (sp.losses(df, D, dead=dead, multi=12, auxk_alpha=0.1, budget=n).first() for n in (1 << 30, 400))
    for n in ("fvu", "auxk", "multi_fvu", "total"):
        assert a[n] == pytest.approx(b[n], rel=1e-9) and a[n] > 0
    assert a["n_dead"] == b["n_dead"] == 8


def test_transform_keeps_columns_and_can_be_off(spark):
    D, _ = make_dict(spark, 8, 4, 2)
    df = spark.createDataFrame([("a", [1.0, 0.0, 2.0, 0.0], 7)], "name string, vec array<double>, label int")
    out = sp.transform(df, D)
    assert out.columns == df.columns and out.first()["name"] == "a" and out.first()["label"] == 7
    assert out.first()["vec"] != df.first()["vec"] and sp.transform(df, D, enabled=False).first() == df.first()


def test_pair_keeps_inputs_without_target(spark):
    a = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "k int, vec array<double>")
    b = spark.createDataFrame([(1, [3.0])], "k int, vec array<double>")
    assert {r["k"]: r["target"] for r in sp.pair(a, b, "k").collect()} == {1: [3.0], 2: None}


def test_blocks_are_bounded_for_clustered_ids(spark):
    d = 4
    ids = list(range(10)) + [10_000 + i for i in range(30)]  # most ids in one narrow range
    rows = [(i, [1.0] * d, 0.0, [0.5] * d) for i in ids]
    e = spark.createDataFrame(rows, "latent_id long, w_enc array<double>, b_enc double, w_dec array<double>")
    D = sp.SparseDictionary(e, [0.0] * d, 2)
    budget = 8 * d * 16  # eight entries per block
    blocks = D.blocks(budget)
    sizes = [sum(1 for i in ids if lo <= i < hi) for lo, hi in blocks]
    assert sum(sizes) == len(ids) and max(sizes) <= 8


@pytest.mark.parametrize("d", [48, 64])
def test_encode_batch_form_equals_relational_form(spark, d):
    D, _ = make_dict(spark, 128, d, 10, seed=d + 1, b_dec=[0.01] * d)
    rng = np.random.default_rng(d)
    x = rng.normal(size=(6, d))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id long, vec array<double>")
    a = sorted((r["id"], r["latent_id"], round(r["act"], 9)) for r in sp.encode(df, D).collect())
    b = sorted((r["id"], r["latent_id"], round(r["act"], 9))
               for r in sp.topk_long(sp.pre_acts_long(df, D), 10).collect())
    assert a == b and len(a) == 6 * 10


def test_groupmax_requires_divisible_k(spark):
    D, _ = make_dict(spark, 10, 4, 3)
    D.activation = "groupmax"
    df = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0])], "id long, vec array<double>")
    with pytest.raises(ValueError, match="divides"):
        sp.encode(df, D)


@pytest.mark.parametrize("pieces", [1, 7])
def test_latent_index_numbers_postings_across_pieces(spark, pieces):
    """A hot entry over several pieces, entries that end or begin with a piece, repeated and missing ids."""
    rng = np.random.default_rng(pieces)
    rows = [(7, int(i)) for i in range(900)] + [(int(l), int(i)) for l, i in zip(rng.integers(0, 12, 500), rng.integers(0, 40, 500))]
    rows += [(3, None), (11, None), (None, 4)]
    codes = spark.createDataFrame(rows, "latent_id long, id long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(pieces))
    try:
        df = sp.latent_index(codes)
        got = sorted((r["latent_id"], r["slot"], r["id"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    held = {}
    for l, i in rows:
        if l is not None:
            held.setdefault(l, []).append(i)
    want = sorted((l, s, i) for l, ids in held.items()
                  for s, i in enumerate(sorted(ids, key=lambda x: (x is not None, x or 0))))
    assert [(a, s) for a, s, _ in got] == [(a, s) for a, s, _ in want]
    assert [i for *_, i in got] == [i for *_, i in want]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("_piece" in line and "latent_id" not in line for line in joins)
    assert sp.latent_index(codes.limit(0)).count() == 0
