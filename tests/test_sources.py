import os
import tempfile

import numpy as np
import pytest

from tessera.sources.token_bin import read_token_bin, write_token_bin


def test_token_file_roundtrip_and_max_examples(spark):
    d = tempfile.mkdtemp(prefix="tok-")
    arr = np.arange(5 * 8, dtype="<u2")
    arr.tofile(os.path.join(d, "a.bin"))
    df = read_token_bin(spark, d, 8, rows_per_split=2)
    rows = sorted((r["idx"], r["input_ids"]) for r in df.collect())
    assert [i for i, _ in rows] == list(range(5))
    assert rows[3][1] == list(range(24, 32))
    assert read_token_bin(spark, d, 8, max_examples=3).count() == 3
    out = "file://" + tempfile.mkdtemp(prefix="tok-out-") + "/new/folder"
    write_token_bin(df.repartition(3), out, 8, order=["idx"])
    assert sorted((r["idx"], r["input_ids"]) for r in read_token_bin(spark, out, 8).collect()) == rows


def test_a_range_of_rows_chooses_the_bytes(spark, tmp_path):
    from tessera.sources.token_bin import _Reader, count_token_rows, read_token_shard
    d, ctx = str(tmp_path), 4
    for name, rows in (("a", 7), ("b", 0), ("c", 12), ("d", 4)):
        np.full(rows * ctx, ord(name), dtype="<u2").tofile(os.path.join(d, name + ".bin"))

    def read_rows(**options):
        r = _Reader({"path": d, "ctx_len": str(ctx), "rows_per_split": "3", **options})
        splits = r.partitions()
        batches = [b for s in splits for b in r.read(s)]
        assert sum(s.rows for s in splits) == sum(b.num_rows for b in batches)
        return [i for b in batches for i in b.column(0).to_pylist()]

    assert read_rows() == list(range(23)) and read_rows(start="6", end="9") == [6, 7, 8]
    assert read_rows(start="22") == [22] and read_rows(start="23") == [] and read_rows(end="0") == []
    assert read_rows(start="18", max_examples="20") == [18, 19] and read_rows(end="3", max_examples="9") == [0, 1, 2]
    df = read_token_bin(spark, d, ctx, rows_per_split=3)
    assert sorted(r["idx"] for r in df.where("idx in (4, 9, 40) and idx > 4").collect()) == [9]
    assert df.where("idx < 3 or idx = 20").count() == 4 and df.count() == 23
    assert read_token_bin(spark, d, ctx, rows_per_split=3, start=6, end=9).rdd.getNumPartitions() == 2
    assert count_token_rows(d, ctx) == 23
    shards = [[r["idx"] for r in read_token_shard(spark, d, ctx, 5, i).orderBy("idx").collect()] for i in range(5)]
    assert [len(s) for s in shards] == [5, 5, 5, 4, 4] and sum(shards, []) == list(range(23))
    assert [r["idx"] for r in read_token_shard(spark, d, ctx, 5, 4, skip=3).collect()] == [22]
    assert read_token_shard(spark, d, ctx, 5, 4, skip=9).count() == 0
    with pytest.raises(ValueError, match="no shard"):
        read_token_shard(spark, d, ctx, 5, 5)


def test_token_file_modes_and_failed_writes(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([([i, i],) for i in range(10)], "input_ids array<int>")
    write_token_bin(df, out, 2)
    with pytest.raises(FileExistsError):
        write_token_bin(df, out, 2)
    write_token_bin(df, out, 2, mode="overwrite")
    assert read_token_bin(spark, out, 2).count() == 10
    write_token_bin(df, out, 2, mode="append")
    assert read_token_bin(spark, out, 2).count() == 20
    before = sorted(os.listdir(out))
    bad = df.unionByName(spark.createDataFrame([([1, 70000],)], "input_ids array<int>"))
    with pytest.raises(Exception, match="uint16"):
        write_token_bin(bad, out, 2, mode="overwrite")
    assert sorted(os.listdir(out)) == before
    with pytest.raises(Exception, match="exactly"):
        write_token_bin(df, out, 3, mode="overwrite")
    empty = str(tmp_path / "e")
    write_token_bin(df.limit(0), empty, 2)
    assert read_token_bin(spark, empty, 2).count() == 0
    with pytest.raises(Exception, match="no token file"):
        read_token_bin(spark, str(tmp_path / "absent"), 2).collect()


def test_state_of_two_writers_and_missing_names(spark, tmp_path):
    from tessera.sources.state_store import read_latent_state, write_latent_state
    path = str(tmp_path / "s")
    rows = lambda n: spark.createDataFrame([("a", 1, n), ("b", 1, n)], "hookpoint string, latent_id bigint, tokens_since_fired bigint")
    write_latent_state(rows(5), path, 0)
    write_latent_state(rows(9).where("hookpoint = 'a'"), path, 1)
    got = {(r["hookpoint"], r["latent_id"]): r["tokens_since_fired"] for r in read_latent_state(spark, path).collect()}
    assert got == {("a", 1): 9, ("b", 1): 5}
    assert read_latent_state(spark, path, ["b"]).count() == 1
    with pytest.raises(KeyError, match="c"):
        read_latent_state(spark, path, ["b", "c"])


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tessera import session

    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_ragged_token_file_is_rejected(spark):
    d = tempfile.mkdtemp(prefix="tok-")
    np.arange(7, dtype="<u2").tofile(os.path.join(d, "r.bin"))
    with pytest.raises(Exception, match="not a multiple"):
        read_token_bin(spark, d, 4).collect()


def test_registry_unknown_key_and_path_or_table(spark, tmp_path):
    from tessera.sources.registry import DatasetRegistry, scan_path
    reg = DatasetRegistry({"docs": "/root/testdata/sf0.001/documents.parquet"})
    assert reg.scan(spark, "docs").count() == 200
    with pytest.raises(ValueError, match="no dataset"):
        reg.scan(spark, "nope")
    spark.range(3).createOrReplaceTempView("tiny_table")
    assert scan_path(spark, "tiny_table").count() == 3
    p = str(tmp_path / "saved")
    spark.range(5).write.parquet(p)
    assert scan_path(spark, p).count() == 5


def test_dictionary_missing_config_and_encoder_only(spark, tmp_path):
    from tessera.operators.sparse import SparseDictionary
    from tessera.sources.dictionary_store import read_dictionary, write_dictionary
    e = spark.createDataFrame([(0, [1.0, 0.0], 0.0, [1.0, 0.0]), (1, [0.0, 1.0], 0.0, [0.0, 1.0])],
                              "latent_id long, w_enc array<double>, b_enc double, w_dec array<double>")
    path = str(tmp_path / "d")
    write_dictionary(SparseDictionary(e, [0.0, 0.0], 1), path, "layers.0.mlp", 7)
    enc_only = read_dictionary(spark, path, "layers.0.mlp", decoder=False)
    assert enc_only.entries.where("w_dec is not null").count() == 0
    assert read_dictionary(spark, path, "layers.0.mlp", checkpoint="step-000000007").num_latents == 2
    with pytest.raises(FileNotFoundError):
        read_dictionary(spark, path, "layers.9.mlp")


def test_read_dictionaries_filters_and_natural_order(spark, tmp_path):
    from tessera.operators.sparse import SparseDictionary
    from tessera.sources.dictionary_store import read_dictionaries, write_dictionary
    e = spark.createDataFrame([(0, [1.0], 0.0, [1.0])], "latent_id long, w_enc array<double>, b_enc double, "
                                                         "w_dec array<double>")
    path = str(tmp_path / "many")
    for hp in ["layers.10.mlp", "layers.2.mlp", "layers.1.mlp", "embed"]:
        write_dictionary(SparseDictionary(e, [0.0], 1), path, hp, 1)
    assert list(read_dictionaries(spark, path)) == ["embed", "layers.1.mlp", "layers.2.mlp", "layers.10.mlp"]
    assert list(read_dictionaries(spark, path, pattern="layers.1*")) == ["layers.1.mlp", "layers.10.mlp"]
    assert list(read_dictionaries(spark, path, layers=[2, 10])) == ["layers.2.mlp", "layers.10.mlp"]
