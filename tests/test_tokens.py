"""Packing and profiling against brute-force models and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import tokens as tk


def brute_pack(docs, chunk, batch_rows, sep="<s>", return_final=False):
    out = []
    for b in range(0, len(docs), batch_rows):
        stream = []
        for d in docs[b:b + batch_rows]:
            stream += [sep] + d
        chunks = [stream[i:i + chunk] for i in range(0, len(stream), chunk)]
        if not return_final:
            chunks = chunks[:-1]
        out += [(b // batch_rows, i, tuple(c)) for i, c in enumerate(chunks)]
    return sorted(out)


def run_pack(spark, docs, chunk, batch_rows, return_final=False, on_empty="skip"):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id long, toks array<string>")
    p = tk.pack(df, "toks", ["id"], chunk=chunk, batch_rows=batch_rows, separator="<s>",
                return_final=return_final, on_empty=on_empty)
    return sorted((r["batch"], r["chunk"], tuple(r["input_ids"])) for r in p.collect())


@pytest.mark.parametrize("chunk,batch_rows,final", [(4, 3, False), (4, 3, True), (7, 100, False), (1, 2, False)])
def test_pack_matches_brute_force(spark, chunk, batch_rows, final):
    rng = np.random.default_rng(7)
    docs = [[f"t{i}_{j}" for j in range(int(rng.integers(0, 12)))] for i in range(23)]
    assert run_pack(spark, docs, chunk, batch_rows, final) == brute_pack(docs, chunk, batch_rows, return_final=final)


def test_pack_exact_multiple_drops_full_last_chunk(spark):
    docs = [["a", "b", "c"], ["d", "e", "f"]]  # stream of 8 = 2 chunks of 4
    assert run_pack(spark, docs, 4, 10) == [(0, 0, ("<s>", "a", "b", "c"))]
    assert len(run_pack(spark, docs, 4, 10, return_final=True)) == 2


def test_pack_zero_chunks_is_an_error(spark):
    with pytest.raises(Exception, match="less than one chunk"):
        run_pack(spark, [["a"]], 4, 10, on_empty="error")
    assert run_pack(spark, [["a"]], 4, 10, on_empty="skip") == []


def test_pack_one_chunk_batch(spark):
    assert run_pack(spark, [["a", "b", "c", "d", "e"]], 4, 10, on_empty="error") == [(0, 0, ("<s>", "a", "b", "c"))]


def test_profile_empty_input_gives_no_row(spark):
    df = spark.createDataFrame([], "n_tokens long")
    assert tk.length_profile(df).count() == 0


def test_profile_matches_numpy(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    df = spark.createDataFrame([(v,) for v in vals], "n_tokens long")
    r = tk.length_profile(df).first()
    assert r["n_rows"] == len(vals) and r["min_len"] == 1 and r["max_len"] == 9
    assert r["p75"] == pytest.approx(np.percentile(vals, 75), abs=1e-6)
    assert r["std_len"] == pytest.approx(np.std(vals), abs=1e-6)


def test_pretokenised_passes_through(spark):
    df = spark.createDataFrame([(1, [5, 6])], "id long, tokens array<int>")
    assert tk.tokenize(df, "text", "tokens") is df


def test_supplied_tokenizer_runs_batched(spark):
    df = spark.createDataFrame([(1, "a bb ccc")], "id long, text string")
    out = tk.tokenize(df, "text", "ids", tokenizer=lambda texts: [[len(w) for w in t.split()] for t in texts])
    assert out.first()["ids"] == [1, 2, 3]


@pytest.mark.parametrize("chunk,batch_rows,final", [(5, 2, False), (3, 4, True), (64, 100, False)])
def test_pack_segments_equals_packing_joined_documents(spark, chunk, batch_rows, final):
    rng = np.random.default_rng(3)
    rows, docs = [], []
    for doc in range(9):
        words = []
        for seg in range(int(rng.integers(1, 6))):
            toks = [f"d{doc}s{seg}w{j}" for j in range(int(rng.integers(0, 7)))]
            rows.append((doc, seg * 10, toks))
            words += toks
        docs.append(words)
    df = spark.createDataFrame(rows, "doc long, seg long, toks array<string>")
    p = tk.pack_segments(df, "toks", ["doc"], ["seg"], chunk=chunk, batch_rows=batch_rows, separator="<s>",
                         return_final=final, on_empty="skip")
    got = sorted((r["batch"], r["chunk"], tuple(r["input_ids"])) for r in p.collect())
    assert got == brute_pack(docs, chunk, batch_rows, return_final=final)


def test_profile_approximate_percentiles_close(spark):
    vals = list(range(1, 1001))
    df = spark.createDataFrame([(v,) for v in vals], "n_tokens long")
    exact = tk.length_profile(df).first()
    approx = tk.length_profile(df, exact=False).first()
    assert abs(approx["p90"] - exact["p90"]) <= 2 and approx["n_rows"] == exact["n_rows"]


def test_pack_segments_zero_chunks_is_an_error(spark):
    df = spark.createDataFrame([(0, 0, ["a"]), (0, 1, ["b"])], "doc long, seg long, toks array<string>")
    with pytest.raises(Exception, match="less than one chunk"):
        tk.pack_segments(df, "toks", ["doc"], ["seg"], chunk=8, batch_rows=4, on_empty="error").collect()
    assert tk.pack_segments(df, "toks", ["doc"], ["seg"], chunk=8, batch_rows=4, on_empty="skip").count() == 0


def test_tokenizer_file_runs_in_workers(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import WhitespaceSplit
    tok = tokenizers.Tokenizer(WordLevel({"[UNK]": 0, "a": 1, "bb": 2, "ccc": 3}, unk_token="[UNK]"))
    tok.pre_tokenizer = WhitespaceSplit()
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    df = spark.createDataFrame([(1, "a bb ccc zz"), (2, "ccc a")], "id long, text string")
    out = tk.tokenize(df, "text", "ids", tokenizer=tk.tokenizer_from_file(path))
    assert sorted((r["id"], r["ids"]) for r in out.collect()) == [(1, [1, 2, 3, 0]), (2, [3, 1])]
