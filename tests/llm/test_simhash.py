import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF_SMALL, sentence

from tessera.llm import simhash
from tessera.llm.common import table


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_brute_force(spark):
    rows = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op10_simhash(spark, SF_SMALL).collect()}
    assert got == want


def test_edges_of_the_input(spark, documents, rng):
    base = sentence(rng, 300)
    texts = [base, base, None, "", " \t\n", "one", "One", "two words", base + " end", sentence(rng, 5000), "naïve ÀB c d e"]
    ids = [5, 3, 9, 8, 7, None, 11, 12, 13, 14, 14]
    got = simhash.components(documents(texts, ids)).collect()
    fps = [brute_fp(t) for t in texts]
    want = sorted(((i, f if f < 2**63 else f - 2**64, c) for i, f, c in zip(ids, fps, brute_components(ids, fps))), key=repr)
    assert sorted(((r.id, r.fp, r.component_id) for r in got), key=repr) == want
    assert simhash.components(documents([])).count() == 0


def test_keep_one_leaves_one_of_each_group(spark, documents, rng):
    base = sentence(rng, 300)
    texts = [sentence(rng, 200), base, base, base + " tail", sentence(rng, 100), base]
    docs = documents(texts, [4, 9, 2, 7, 4, None])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "None"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sets(st.integers(0, 63), max_size=5), st.integers(0, 2)), max_size=80))
def test_trees_find_all_links(items):
    centre = np.random.default_rng(1).integers(0, 2**63, 4, dtype=np.uint64)
    pairs = sorted({(k, int(centre[c]) ^ sum(1 << b for b in bits)) for c, bits, k in items})
    keys, fps = np.array([k for k, _ in pairs], np.int64), np.array([f for _, f in pairs], np.uint64)
    label = simhash._links(keys, fps, 4, chunk=7) if pairs else []
    want = brute_components([int(i) for i in range(len(pairs))], [f | k << 70 | (k * 0x5555555555 << 80) for k, f in pairs])
    assert list(label) == want


def test_split_shards_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**62, 6)
    fps = sorted({int(c) ^ sum(1 << int(b) for b in rng.integers(0, 62, rng.integers(0, 6))) for c in centre for _ in range(60)})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    want = brute_components(list(range(len(fps))), fps)
    for size in (5, 50, 4096):
        star = {r.node: r.root for r in simhash.classes(simhash.links(nodes, 4, max_shard=size)).collect()}
        groups, least = {}, {}
        for i, f in enumerate(fps):
            groups.setdefault(star.get(f, f), set()).add(i)
        for members in groups.values():
            least |= {i: min(members) for i in members}
        assert [least[i] for i in range(len(fps))] == want


def test_classes_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(70)] + [(100, 200)], "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.classes(edges).collect()}
    assert got == {**{i: 0 for i in range(71)}, 100: 100, 200: 100}
