from llm_helpers import agrees, sentence

from tessera.llm import chats


def brute(rows):
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        convs.setdefault(c, []).append((r, x))
    first, copies = {}, {}
    for c, said in convs.items():  # in order of id, null first
        copies[tuple(said)] = copies.get(tuple(said), 0) + 1
        first.setdefault(tuple(said), c)
    long = {s[:i] for s in first for i in range(1, len(s))}
    return sorted(((c, len(s), copies[s], "".join(f"<|start|>{'unknown' if r is None else r}\n{x or ''}<|end|>\n" for r, x in s))
                   for s, c in first.items() if s not in long), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, piece int")


def joined(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: r.part):
        n, c, t = got.get(r.conv_id, (r.n_turns, r.copies, ""))
        got[r.conv_id] = (n, c, t + r.text)
    return sorted(((c, *v) for c, v in got.items()), key=repr)


def test_oracle_agrees_on_the_smallest_tables(spark):
    agrees(spark, "op3_chats")


def test_snapshots_copies_and_edges(spark, rng):
    rows = []
    talks = [[(rng.choice(["user", "assistant"]), sentence(rng, 4)) for _ in range(rng.randrange(1, 9))] for _ in range(12)]
    ids = iter(range(1000))
    for talk in talks:
        for n in {1, len(talk), rng.randrange(1, len(talk) + 1)}:
            for _ in range(rng.randrange(1, 3)):
                c, start = next(ids), rng.randrange(3)
                rows += [(c, start + 2 * i, *t) for i, t in enumerate(talk[:n])]
    hot = ("user", "hello")
    for i in range(60):  # one very common first turn
        c = next(ids)
        rows += [(c, 0, *hot)] + ([(c, 1, "assistant", f"answer {i % 20}")] if i % 3 else [])
    c = next(ids)
    rows += [(c, None, "user", "a"), (c, 1, None, None), (c, 1, None, ""), (c, 1, "", "b"), (c, 1, "", "b"), (None, 1, "user", "x")]
    c = next(ids)
    rows += [(c, i, "user", str(i)) for i in range(1500)]
    assert joined(chats.render(table(spark, rows))) == brute(rows)
    assert joined(chats.render(table(spark, rows), turns_per_row=3)) == brute(rows)


def test_empty(spark):
    assert chats.render(table(spark, [(1, 0, "a", "b")]).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    from llm_helpers import SF_SMALL
    plan = chats.op3_chats(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
