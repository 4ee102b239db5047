import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import SF_SMALL, sentence
from tokenizers import Tokenizer

from tessera.llm import lm

PATH = public_tokenizers.path("word_bpe_49k.json")


def words_of(text):
    return (text or "").encode().lower().split()


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def base(rows):
    """(n_tokens, n_known, N, base score) of (id, text) by the contract's formula."""
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words_of(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        tokens = [*words_of(t), None]
        out.append((len(tokens), sum(c[w] > 0 for w in tokens), n,
                    sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out


def plain_score(model, ids):
    """The same model, one id after the other."""
    y = [model.layout.end, *ids, model.layout.end]
    half, total = lm.WINDOW // 2, 0.0
    for t in range(len(y) - 1):
        x = model.layout.input[y[t]]
        first = max(0, t // half * half - half)
        w = np.array([math.exp(model.q[x] @ model.k[model.layout.input[y[j]]]) * float(model.near[t % half, half + t % half - (t - j)])
                      for j in range(first, t + 1)])
        h = sum(a * model.v[model.layout.input[y[j]], :-1] for a, j in zip(w / w.sum(), range(first, t + 1)))
        z = model.logits[x] + h @ model.o
        goal = y[t + 1]
        cls, rank = model.layout.cls[goal], model.layout.rank[goal]
        total += z[cls] - np.log(np.exp(z).sum())
        total += model.shares.frequent[x, rank] if rank < lm.OWN_INPUTS else model.layout.share[goal] + model.shares.rest[x, cls]
    return total


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in lm.op5_lm(spark, SF_SMALL).collect()}


def test_base_equals_brute_force(spark, scored, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert len(scored) == len(rows)
    for (i, _), (tokens, known, n, score) in zip(rows, base(rows)):
        r = scored[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), tokens, known, n)
        assert abs(r.base_score - score) < 1e-6


def test_held_out_scores_are_near_the_base_on_very_little_text(scored):
    rows = [r for r in scored.values() if r.held_out]
    assert all(r.score < 0 and math.isfinite(r.score) for r in scored.values())
    # half a megabyte of text: near the base; above it from some 25 MB on (see the README)
    assert sum(r.score for r in rows) > 1.25 * sum(r.base_score for r in rows)


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    n = len(Tokenizer.from_file(PATH).get_vocab())
    counts = np.zeros(n + 1)
    counts[rng.integers(0, n, 5000)] += rng.integers(1, 500, 5000)
    layout = lm.Layout(counts)
    cells = np.where(rng.random(lm._CELLS) < 0.01, rng.integers(1, 30, lm._CELLS), 0).astype(float)
    p = lm.fresh(seed)
    p["o"] = rng.normal(0, 0.3, p["o"].shape).astype(np.float32)
    return lm.Scorer(layout, lm.Shares(layout, cells), p), n


def test_windows_equal_one_by_one():
    model, n = random_model()
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, n, k) for k in (0, 1, 7, 8, 9, 15, 16, 17, 40, 0, 100)]
    got = model.score(np.concatenate(texts), np.array([len(t) for t in texts]), at_once=3)
    for t, s in zip(texts, got):
        assert abs(plain_score(model, t.tolist()) - s) < 1e-3 * max(1, len(t))


def test_probabilities_of_the_next_id_sum_to_one():
    model, n = random_model(3)
    for x in (0, 7, lm.INPUTS - 1):
        rank, cls = model.layout.rank, model.layout.cls
        within = np.where(rank < lm.OWN_INPUTS, model.shares.frequent[x, np.minimum(rank, lm.OWN_INPUTS - 1)],
                          model.layout.share + model.shares.rest[x, cls])
        assert np.allclose(np.bincount(cls, np.exp(within), lm.CLASSES), 1, atol=1e-4)
        assert abs(np.exp(model.logits[x]).sum() - 1) < 1e-4


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(2)
    p = {n: x.astype(np.float64) for n, x in lm.fresh(1).items()}
    p["o"] = rng.normal(0, 0.5, p["o"].shape)
    ctx, mask = rng.integers(0, 9, (6, lm.WINDOW)), rng.random((6, lm.WINDOW)) < 0.8
    mask[:, -1] = True
    logits, goal = rng.normal(0, 1, (6, lm.CLASSES)), rng.integers(0, lm.CLASSES, 6)
    g, _ = lm.gradients(p, ctx, mask, logits, goal)
    for n in p:
        for _ in range(6):
            at = tuple(rng.integers(0, 9 if n == "E" and i == 0 else k) for i, k in enumerate(p[n].shape))
            values = []
            for d in (1e-5, -1e-5):
                p[n][at] += d
                values.append(lm.gradients(p, ctx, mask, logits, goal)[1])
                p[n][at] -= d
            assert abs((values[0] - values[1]) / 2e-5 - g[n][at]) < 1e-5, n


def test_gradients_of_many_targets_sum_those_of_one():
    rng = np.random.default_rng(3)
    p = {n: x.astype(np.float64) for n, x in lm.fresh(1).items()}
    p["o"] = rng.normal(0, 0.5, p["o"].shape)
    half = lm.WINDOW // 2
    ctx, mask = rng.integers(0, 9, (5, lm.WINDOW)), rng.random((5, lm.WINDOW)) < 0.8
    mask[:, half:] = True
    logits, goal = rng.normal(0, 1, (5, half, lm.CLASSES)), rng.integers(0, lm.CLASSES, (5, half))
    live = rng.random((5, half)) < 0.7
    want = {n: 0 for n in p}
    for i in range(half):  # the target's place last, what is before the window masked
        seen = half + i + 1
        c, k = np.zeros_like(ctx), np.zeros_like(mask)
        c[:, -seen:], k[:, -seen:] = ctx[:, :seen], mask[:, :seen]
        for j in np.flatnonzero(live[:, i]):
            g, _ = lm.gradients(p, c[j:j + 1], k[j:j + 1], logits[j:j + 1, i], goal[j:j + 1, i])
            want = {n: want[n] + g[n] / live.sum() for n in p}
    got, _ = lm.gradients(p, ctx, mask, logits, goal, live)
    assert all(np.allclose(got[n], want[n], atol=1e-10) for n in p)


def test_every_training_position_is_a_target_once(spark, documents, rng):
    texts = [None, "", "the", *(sentence(rng, n) for n in (3, 7, 8, 9, 40, 300))] * 5
    held_ = lm.blocks(documents(texts), PATH)
    layout = lm.Layout(np.ones(49409))
    for r in held_.toArrow().to_batches():
        for _, b in lm._each([r]):
            ids, sizes = b.ids(~b.held)
            want = np.r_[ids.astype(np.int64), np.full((~b.held).sum(), layout.end)]
            turns = [lm.training_windows(b, layout, t) for t in range(lm.ROUNDS)]
            assert sorted(np.concatenate([goal[live] for _, _, goal, live in turns])) == sorted(want)


def test_training_lowers_the_loss(spark, documents, rng):
    pattern = [sentence(rng, 6) for _ in range(5)]
    held_ = lm.blocks(documents([" ".join(rng.choice(pattern) for _ in range(60)) for _ in range(80)]), PATH)
    model = lm.fit(held_, 49408)
    start = lm.Scorer(model.layout, model.shares, lm.fresh())
    ids, sizes = [], []
    for r in held_.toArrow().to_batches():
        for _, b in lm._each([r]):
            i, n = b.ids()
            ids.append(i)
            sizes.append(n)
    ids, sizes = np.concatenate(ids), np.concatenate(sizes)
    assert model.score(ids, sizes).sum() > start.score(ids, sizes).sum()
    model.q = model.q * np.float32(500)  # attention logits beyond what exp holds
    assert np.isfinite(model.score(ids, sizes)).all()


def test_word_of_very_many_pieces(spark, documents, rng):
    long = "".join(rng.choice("0123456789abcdef") for _ in range(200_000))
    texts = [f"the {long} of", "the of", "and the of"]
    rows = lm.scores(documents(texts, [3, 4, 5]), PATH).collect()
    got = {r.doc_id: r.n_ids for r in rows}
    known = Tokenizer.from_file(PATH)
    assert got[3] > 1 << 16 and all(got[i] == len(known.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip((3, 4, 5), texts))
    assert all(math.isfinite(r.score) for r in rows)


def test_edges_of_the_input(spark, documents, rng, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 4)
    texts = [None, "", " \n ", "The the THE", "Ünï cödé", "x" * 4000, "<|endoftext|> a", sentence(rng, 4000), "the", "the"]
    ids = [0, 1, None, 3, 4, 5, 6, 7, 8, 8]
    rows = lm.scores(documents(texts, ids), PATH).collect()
    want = sorted(zip(ids, base(list(zip(ids, texts)))), key=repr)
    got = sorted(((r.doc_id, (r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in rows), key=repr)
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1][:3] for g in got] == [w[1][:3] for w in want]
    assert all(abs(g[1][3] - w[1][3]) < 1e-6 for g, w in zip(got, want)) and all(math.isfinite(r.score) for r in rows)
    assert lm.scores(documents([]), PATH).count() == 0
    only = next(i for i in range(100) if held(i))
    r = lm.scores(documents(["a b"], [only]), PATH).first()
    assert (r.held_out, r.n_known, r.train_tokens) == (True, 0, 0) and math.isfinite(r.score)


def test_steps_on_one_array_equal_those_on_each():
    """Adam by its formula, on the arrays that the caller holds."""
    rng = np.random.default_rng(4)
    p = {n: x.astype(np.float64) for n, x in lm.fresh(2).items()}
    want, m, s = ({n: f(x) for n, x in p.items()} for f in (np.copy, np.zeros_like, np.zeros_like))
    adam = lm.Adam(p)
    assert all(np.shares_memory(x, adam.x) for x in p.values())
    for t in range(1, 4):
        g = {n: rng.normal(0, 1, x.shape) for n, x in p.items()}
        adam.step(g)
        for n in want:
            m[n], s[n] = 0.9 * m[n] + 0.1 * g[n], 0.99 * s[n] + 0.01 * g[n] ** 2
            want[n] -= lm.RATE * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t) * m[n] / (np.sqrt(s[n]) + 1e-8)
    assert all(np.allclose(p[n], want[n], atol=1e-12) for n in p)


@pytest.mark.parametrize("rows", [0, 1, lm.SLICE - 1, lm.SLICE, 3 * lm.SLICE + 5])
def test_products_of_slices_equal_one(rows):
    rng = np.random.default_rng(rows)
    a, b = rng.normal(size=(rows, 3)), rng.normal(size=(rows, 5))
    assert np.allclose(lm._product(a, b), a.T @ b)
