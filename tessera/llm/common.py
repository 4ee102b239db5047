"""Shared helpers: reading tables, scratch tables in the shared folder, row ids."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.positions import laid_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors
    share. Without the setting a local session (tests) gets one of its own;
    any other master must name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tessera-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a scratch table and read it back: cuts the lineage at
    files that every executor can reach again, and computes ``df`` once."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``pos``: a row's place in its ``tree`` by ``order``. Rows are laid out by
    range; a range's part of a tree starts where the earlier ranges end."""
    laid = laid_out(nodes.withColumn("_one", F.lit(1)), ["tree", *order], "_one")
    parts = laid.groupBy("_piece", "tree").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_piece", "tree", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return (laid.join(parts, ["_piece", "tree"])
            .withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before"))
            .select(*nodes.columns, "pos"))


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    for x in more:
        first = first.unionByName(x)
    return first


def ascii_lower(col):
    """Lower-case A-Z only, as the contracts of the word operators ask."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranges(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of things of these sizes, of about ``most`` each (at least one thing)."""
    size = np.cumsum(sizes)
    start, done = 0, 0
    while start < len(size):
        end = min(int(np.searchsorted(size, done + most)) + 1, len(size))
        yield start, end
        start, done = end, int(size[end - 1])


#: numbers gathered at once: the index is several times their size
GATHERED = 1 << 18


def gather(flat: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The runs ``picks`` of ``flat`` (cut into runs of ``sizes``), in a row."""
    starts = np.cumsum(sizes) - sizes
    n = sizes[picks]
    out, at = np.empty(int(n.sum()), flat.dtype), 0
    for i, j in ranges(n, GATHERED):
        own = n[i:j]
        ends = np.cumsum(own)
        more = int(ends[-1])
        out[at:at + more] = flat[np.repeat(starts[picks[i:j]] - ends + own, own) + np.arange(more)]
        at += more
    return out


def text_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of an Arrow column of texts of about ``most`` bytes each."""
    yield from ranges(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64), most)
