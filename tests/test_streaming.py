"""The since-fired stream is incremental and restartable: a second run on the
same checkpoint processes only new files and ends in the batch answer."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.streaming.since_fired import FIRE_SCHEMA, last_fired_stream


def test_stream_resumes_from_checkpoint(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    first = [(0, 1, 10), (0, 2, 10), (1, 1, 25)]
    second = [(2, 2, 40), (3, 3, 55), (3, 1, 55)]
    spark.createDataFrame(first, FIRE_SCHEMA).write.mode("append").parquet(src)
    s1 = {r["latent_id"]: r["last_cum"] for r in last_fired_stream(spark, src, out, ckpt).collect()}
    assert s1 == {1: 25, 2: 10}
    spark.createDataFrame(second, FIRE_SCHEMA).write.mode("append").parquet(src)
    s2 = {r["latent_id"]: r["last_cum"] for r in last_fired_stream(spark, src, out, ckpt).collect()}
    batch = (spark.createDataFrame(first + second, FIRE_SCHEMA).groupBy("latent_id")
             .agg(F.max("cum_tokens").alias("c")).collect())
    assert s2 == {r["latent_id"]: r["c"] for r in batch} == {1: 55, 2: 40, 3: 55}
