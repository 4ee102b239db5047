"""Sharded entry state (A5) and appended metric logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_latent_state(state: DataFrame, path: str, writer: int) -> None:
    """One writer's state ``(hookpoint, latent_id, tokens_since_fired)``; every
    writer owns its own partition, so writers never overwrite each other."""
    (state.withColumn("writer", F.lit(int(writer)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("writer").parquet(path))


def read_latent_state(spark: SparkSession, path: str, hookpoints=None) -> DataFrame:
    """Merged state of all writers (A5): one row per entry, from the writer
    with the highest number where several hold it. ``hookpoints`` keeps the
    named ones, and raises if a name is absent."""
    st = spark.read.parquet(path)
    if hookpoints is not None:
        names = list(hookpoints)
        st = st.where(F.col("hookpoint").isin(names))
        # at most one row per requested name
        absent = set(names) - {r["hookpoint"] for r in st.select("hookpoint").distinct().collect()}
        if absent:
            raise KeyError(f"no stored state for {', '.join(sorted(absent))} under {path}")
    return st.groupBy("hookpoint", "latent_id").agg(F.max_by("tokens_since_fired", "writer").alias("tokens_since_fired"))


def to_long_metrics(df: DataFrame, ids, metrics) -> DataFrame:
    """Wide metric columns to ``(ids..., metric, value)`` rows (unpivot)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    return df.unpivot(ids, list(metrics), "metric", "value")


def append_metrics(df: DataFrame, path: str, ids, metrics) -> None:
    """Append step-keyed metric rows in long form."""
    to_long_metrics(df, ids, metrics).write.mode("append").parquet(path)
