import numpy as np
from pyspark.sql import functions as F

from tessera.operators import health as hl


def test_since_fired_matches_loop(spark):
    rng = np.random.default_rng(11)
    L, steps = 6, 40
    tokens = rng.integers(1, 9, size=steps)
    fires = [(s, l) for s in range(steps) for l in range(L) if rng.uniform() < 0.15 and l != 5]
    counts, history = np.zeros(L, dtype=np.int64), {}
    for s in range(steps):
        counts += tokens[s]
        for (ss, l) in fires:
            if ss == s:
                counts[l] = 0
        history.update({(s, l): int(counts[l]) for l in range(L)})
    codes = spark.createDataFrame(fires, "step long, latent_id long")
    rows = spark.createDataFrame([(s, int(t)) for s in range(steps) for t in [tokens[s]]], "step long, t long")
    steps_df = hl.step_tokens(rows, "step", "t")
    entries = spark.range(0, L).withColumnRenamed("id", "latent_id")
    got = {r["latent_id"]: r["tokens_since_fired"] for r in hl.tokens_since_fired(codes, steps_df, entries).collect()}
    assert [got[i] for i in range(L)] == counts.tolist()
    share = hl.dead_share(hl.tokens_since_fired(codes, steps_df, entries), int(tokens.sum()) + 1).first()
    assert share["n_dead"] == 0 and share["dead_share"] == 0.0
    asked = entries.crossJoin(spark.range(0, steps).withColumnRenamed("id", "step"))
    told = hl.since_fired_at(codes, steps_df, asked.unionByName(asked), "step").collect()
    assert {(r["step"], r["latent_id"]): r["tokens_since_fired"] for r in told} == history and len(told) == len(history)
    for at in (0, 17):
        dead = {r["latent_id"] for r in hl.dead_at(codes, steps_df, entries, at, 9).collect()}
        assert dead == {l for l in range(L) if history[at, l] > 9}
    by = {r["step"]: r["n_dead"] for r in hl.dead_by_step(codes, steps_df, entries, [3, 20], 9).collect()}
    assert by == {s: sum(history[s, l] > 9 for l in range(L)) for s in (3, 20)}
