import hashlib
import zlib

import pytest
from llm_helpers import agrees

from tessera.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves):
    """Root, and each leaf's path of (sibling or None, sibling is left)."""
    level, paths, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            other = p ^ 1
            paths[i].append((level[other] if other < len(level) else None, p % 2 == 1))
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        mine = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
        trees[lang] = (mine, *brute_tree([brute_leaf(r) for r in mine]))
    root, tops = brute_tree([trees[x][1] for x in order])
    out = []
    for lang, top in zip(order, tops, strict=True):
        mine, subroot, paths = trees[lang]
        for r, p in zip(mine, paths, strict=True):
            path = p + top
            bad = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            x = brute_leaf(r, int(bad))
            for sibling, left in path:
                x = h(x) if sibling is None else h(sibling, x) if left else h(x, sibling)
            out.append((r["doc_id"], brute_leaf(r), subroot, root, h(*[s for s, _ in path if s]), x, x == root))
    return out


def result(spark, tmp_path, docs):
    docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in merkle.op13_merkle(spark, str(tmp_path)).collect()]


def key(row):
    return str(row)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, pos int, digest string"


@pytest.mark.parametrize("sizes", [(1,), (3, 1), (9, 4, 1, 6), (33, 17)])
def test_equals_brute_force(spark, sizes):
    from pyspark.sql import functions as F
    rows, names = [], [None, "", "de", "z", "é"]
    for k, n in enumerate(sizes):
        for i in range(n):
            rows.append({"doc_id": 100 * k + 3 * i, "text": [None, "", "a é" * i][i % 3], "lang": names[k],
                         "source": [None, "s"][i % 2], "n_chars": [None, i][i % 4 != 0], "tree": "x", "pos": 5, "digest": "y"})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    for span in (4, 512):
        got = [tuple(r) for r in merkle.manifest(df, chosen, span).drop("proof").collect()]
        assert sorted(got, key=key) == sorted(brute(rows), key=key), span


def test_ties_nulls_repeats_and_an_empty_table(spark, tmp_path):
    base = {"doc_id": 7, "text": "x", "lang": "en", "source": "s", "n_chars": 1, "tree": "", "pos": 0, "digest": ""}
    rows = [base, dict(base), {**base, "text": "y"}, {**base, "doc_id": None}, {**base, "doc_id": None, "lang": None},
            {**base, "text": "long " * 200000}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    assert sorted(result(spark, tmp_path, df), key=key) == sorted(brute(rows), key=key)
    assert result(spark, tmp_path, df.limit(0)) == []


def test_a_proof_names_the_changed_row_only(spark):
    from pyspark.sql import functions as F
    df = spark.range(700).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                 F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(3).cast("long").alias("n_chars"))
    got = merkle.manifest(df, F.col("doc_id") == 511, 8).collect()
    assert [r.doc_id for r in got if not r.verified] == [511]
    assert {r.folded_root for r in got if r.verified} == {got[0].root}
    assert all(merkle.fold(r.leaf, merkle.steps(r.proof)) == r.root for r in got)


def test_oracle_agrees_on_the_smallest_tables(spark):
    agrees(spark, "op13_merkle")
