"""Streaming form of tokens-since-fired (F2).

Keyed state per entry is the cumulative token count at the end of the last
step in which it fired: a built-in streaming ``max`` aggregation keyed by
``latent_id`` (RocksDB state store), fed by an append-only stream of fire
events ``(step, latent_id, cum_tokens)``. The counter of any entry at any
time is ``cum_tokens(now) - last_cum``, so entries that do not fire need no
state update, unlike a per-step dense counter vector.

Each micro-batch's updated keys go to Parquet through ``foreachBatch``,
partitioned by batch id with dynamic overwrite, so a replayed batch after a
failure rewrites its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRE_SCHEMA = T.StructType([T.StructField("step", T.LongType()), T.StructField("latent_id", T.LongType()),
                            T.StructField("cum_tokens", T.LongType())])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def last_fired_stream(spark: SparkSession, source: str, out: str, checkpoint: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream over every file now in ``source`` (available-now trigger)
    and return the merged state ``(latent_id, last_cum)``. A micro-batch takes
    all new files unless ``max_files_per_trigger`` says otherwise. The state
    store is set for this query's own session, not for the caller's."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    source_ = own.readStream.schema(FIRE_SCHEMA)
    if max_files_per_trigger:
        source_ = source_.option("maxFilesPerTrigger", max_files_per_trigger)
    events = source_.parquet(source)
    state = events.groupBy("latent_id").agg(F.max("cum_tokens").alias("last_cum"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out))

    q = (state.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    # later batches only raise last_cum, so the max over all batches is the state
    return spark.read.parquet(out).groupBy("latent_id").agg(F.max("last_cum").alias("last_cum"))


def since_fired_from_state(state: DataFrame, entries: DataFrame, total_tokens: int) -> DataFrame:
    """Counters ``total - last_cum`` for every entry (never fired: ``total``)."""
    from tessera.operators.health import since_from_last
    return since_from_last(entries, state, total_tokens)
