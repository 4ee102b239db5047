"""Dictionary storage (A6-A8): entry tables in Parquet partitioned by
``hookpoint`` and ``checkpoint``, with a one-row JSON config per partition.

Reading one hookpoint is a partition-pruned scan; ``decoder=False`` prunes
the ``w_dec`` column from the scan. Each save writes the step checkpoint
and a ``latest`` copy; dynamic partition overwrite replaces only the
partitions being written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import matches_any_glob, natural_sort_keys
from tessera.operators.sparse import SparseDictionary

CONFIG_FIELDS = ("d_in", "num_latents", "k", "transcode", "activation", "b_dec", "w_skip")

CONFIG_SCHEMA = T.StructType([
    T.StructField("hookpoint", T.StringType()), T.StructField("checkpoint", T.StringType()),
    T.StructField("d_in", T.LongType()), T.StructField("num_latents", T.LongType()),
    T.StructField("k", T.LongType()), T.StructField("transcode", T.BooleanType()),
    T.StructField("activation", T.StringType()), T.StructField("b_dec", T.ArrayType(T.DoubleType())),
    T.StructField("w_skip", T.ArrayType(T.ArrayType(T.DoubleType())))])


def _checkpoint_name(step: int) -> str:
    return f"step-{int(step):09d}"


def write_dictionary(D: SparseDictionary, path: str, hookpoint: str, step: int) -> None:
    """Save a dictionary as checkpoint ``step`` and as ``latest``."""
    spark = D.entries.sparkSession
    for ckpt in (_checkpoint_name(step), "latest"):
        (D.entries.select("latent_id", "w_enc", "b_enc", "w_dec")
         .withColumn("hookpoint", F.lit(hookpoint)).withColumn("checkpoint", F.lit(ckpt))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("hookpoint", "checkpoint").parquet(f"{path}/entries"))
        cfg = [(hookpoint, ckpt, D.d, D.num_latents, D.k, D.transcode, D.activation,
                [float(v) for v in D.b_dec], None if D.w_skip is None else D.skip_matrix().tolist())]
        (spark.createDataFrame(cfg, CONFIG_SCHEMA).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("hookpoint", "checkpoint").json(f"{path}/config"))


def list_hookpoints(spark: SparkSession, path: str, checkpoint: str = "latest") -> DataFrame:
    """Stored hookpoints of a checkpoint (one row per hookpoint)."""
    cfg = spark.read.schema(CONFIG_SCHEMA).json(f"{path}/config")
    return cfg.where(F.col("checkpoint") == checkpoint).select("hookpoint").distinct()


def read_dictionary(spark: SparkSession, path: str, hookpoint: str, checkpoint: str = "latest",
                    decoder: bool = True) -> SparseDictionary:
    """Load one dictionary (A7); a missing config is an error; unknown config fields are ignored."""
    cfg_rows = (spark.read.schema(CONFIG_SCHEMA).json(f"{path}/config")
                .where((F.col("hookpoint") == hookpoint) & (F.col("checkpoint") == checkpoint))
                .select(*CONFIG_FIELDS).limit(2).collect())
    if not cfg_rows:
        raise FileNotFoundError(f"no config for hookpoint {hookpoint!r} checkpoint {checkpoint!r} under {path}")
    if len(cfg_rows) > 1:
        raise ValueError(f"more than one config for hookpoint {hookpoint!r} checkpoint {checkpoint!r} under {path}")
    cfg = cfg_rows[0].asDict()
    cols = ["latent_id", "w_enc", "b_enc"] + (["w_dec"] if decoder else [])
    entries = (spark.read.parquet(f"{path}/entries")
               .where((F.col("hookpoint") == hookpoint) & (F.col("checkpoint") == checkpoint))
               .select(*cols))
    if not decoder:
        entries = entries.withColumn("w_dec", F.lit(None).cast("array<double>"))
    return SparseDictionary(entries=entries, b_dec=list(cfg["b_dec"]), k=int(cfg["k"]),
                            transcode=bool(cfg["transcode"]), w_skip=cfg["w_skip"],
                            activation=cfg["activation"] or "topk")


def read_dictionaries(spark: SparkSession, path: str, pattern=None, layers=None,
                      checkpoint: str = "latest", decoder: bool = True) -> dict[str, SparseDictionary]:
    """Load many dictionaries (A6): hookpoints filtered by glob pattern(s) or
    explicit layer numbers, in natural order."""
    hp = list_hookpoints(spark, path, checkpoint)
    if pattern is not None:
        hp = hp.where(matches_any_glob("hookpoint", pattern))
    if layers is not None:
        hp = hp.where(F.regexp_extract("hookpoint", r"layers\.(\d+)", 1).try_cast("bigint")
                      .isin([int(x) for x in layers]))
    # one name per stored module: bounded by the model's module count
    names = [r["hookpoint"] for r in hp.orderBy(*natural_sort_keys("hookpoint")).collect()]
    return {h: read_dictionary(spark, path, h, checkpoint, decoder) for h in names}
