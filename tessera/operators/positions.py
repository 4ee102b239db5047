"""Positional operators over an explicit order: global index, shuffle, head,
shard, skip, batch and micro-chunk ids (D7-D13).

Rows of a DataFrame have no order, so every positional operator takes the
ordering columns explicitly. The order must be total (unique); add the
primary key as the last column to break ties.

The global index avoids the single-partition ``row_number() over (order
by ...)`` window: rows are range-partitioned on the order, numbered locally
with ``monotonically_increasing_id`` (partition id in the upper bits), and
shifted by the running count of the earlier partitions. The offsets table
has one row per partition, so broadcasting it is bounded by the partition
count, not the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c, seeded_hash

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _order_cols(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [c(o) for o in order]


def with_index(df: DataFrame, order, name: str = "row_index",
               total: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a dense 0-based global position following ``order``.

    The range-partitioned, sorted rows are materialised once with a
    reliable ``checkpoint()`` in the shared checkpoint folder: per-partition
    counts and row numbers then come from the same partitions by
    construction. (Without it, the count branch would run its own range
    exchange, whose sampled bounds can differ from the main branch's when
    the input is itself a shuffle output with non-deterministic row order.)
    Pass a narrow table (keys and a few columns): every column is written.

    With ``total`` set, also attach the row count of the whole input, taken
    from the same per-partition counts (an equi-join on the partition id).
    """
    from tessera.session import checkpoint_dir
    cols = _order_cols(order)
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols).checkpoint(eager=True)
    tagged = (ranged.withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("bigint"), _LOCAL_BITS)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # at most num_partitions rows: the un-partitioned window and the
    # broadcast are bounded by the partition count, not by the data
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_tot"))
    out = (tagged.join(F.broadcast(offsets), "_pid")
           .withColumn(name, F.col("_off") + F.col("_local")))
    if total:
        out = out.withColumn(total, F.col("_tot"))
    return out.drop("_pid", "_local", "_off", "_tot")


def shuffle_order(seed: int, key) -> list[Column]:
    """Order columns for a seeded, partition-independent shuffle."""
    return [seeded_hash(seed, key), c(key)]


def shuffle(df: DataFrame, seed: int, key: str, name: str = "shuffle_rank") -> DataFrame:
    """Seeded shuffle: each row gets its position in the shuffled order."""
    return with_index(df, shuffle_order(seed, key), name)


def head(df: DataFrame, n: int, order) -> DataFrame:
    """First ``n`` rows in ``order`` (D8): per-partition top-n, then merge."""
    return df.orderBy(*_order_cols(order)).limit(n)


def shard_of(index, total, num_shards: int) -> Column:
    """Contiguous shard of a 0-based index; the first ``total mod s`` shards get one more row."""
    i, n = c(index), c(total)
    q = F.floor(n / num_shards)
    rem = n - q * num_shards
    big = rem * (q + 1)
    return F.when(i < big, F.floor(i / (q + 1))).otherwise(rem + F.floor((i - big) / q)).cast("bigint")


def shard(df: DataFrame, num_shards: int, shard_id: int | None, order) -> DataFrame:
    """Rows of shard ``shard_id`` (or all rows with a ``shard`` column when None)."""
    x = with_index(df, order, "_i", total="_n").withColumn("shard", shard_of("_i", "_n", num_shards))
    if shard_id is not None:
        x = x.where(F.col("shard") == shard_id)
    return x.drop("_i", "_n")


def skip(df: DataFrame, n: int, order, index_name: str = "row_index") -> DataFrame:
    """Drop the first ``n`` rows in ``order`` (resume offset, D10)."""
    return with_index(df, order, index_name).where(F.col(index_name) >= n)


def batch_ids(df: DataFrame, size: int, order, name: str = "batch",
              index_name: str = "row_index") -> DataFrame:
    """Mini-batch id ``floor(index / size)`` (D11); the last batch may be short."""
    return with_index(df, order, index_name).withColumn(name, F.floor(F.col(index_name) / size).cast("bigint"))


def micro_chunks(df: DataFrame, pieces: int, by: str, order, name: str = "micro") -> DataFrame:
    """Split each ``by`` group into at most ``pieces`` parts of ``ceil(n/pieces)`` rows.

    The group is a mini-batch, whose size is fixed by the caller, so the
    window below is bounded by the batch size.
    """
    w = Window.partitionBy(by).orderBy(*_order_cols(order))
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    size = F.ceil(n / pieces)
    return df.withColumn(name, F.floor((F.row_number().over(w) - 1) / size).cast("bigint"))


def _ranged(df: DataFrame, cols: list[Column], num_partitions: int | None):
    """Range-partitioned, sorted rows materialised once (see :func:`with_index`),
    tagged with their partition id."""
    from tessera.session import checkpoint_dir
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols).checkpoint(eager=True)
            .withColumn("_pid", F.spark_partition_id()))


def _bounds(keys: DataFrame, names: list[str], pieces: int, per_piece: int = 64) -> list:
    """Up to ``pieces - 1`` rising key rows that cut ``keys`` into even pieces:
    quantiles of a sample of about ``per_piece`` rows for each piece."""
    n = keys.count()
    share = min(1.0, pieces * per_piece / n) if n else 1.0
    drawn = (keys if share == 1.0 else keys.sample(False, share, 17)).orderBy(*names).collect()
    at = sorted({len(drawn) * i // pieces for i in range(1, pieces)} - {0})
    return [drawn[i] for i in at]


def _piece_of(names: list[str], schema, bounds: list) -> Column:
    """How many bounds are not above the row's key: a search over every m-th
    bound, then over the m - 1 that follow it. The key is computed once."""
    if not bounds:
        return F.lit(0)

    def key(row):
        return F.struct(*[F.lit(row[n]).cast(schema[n].dataType).alias(n) for n in names])

    m = max(1, int(len(bounds) ** 0.5))
    every, coarse = F.array(*[key(b) for b in bounds]), F.array(*[key(b) for b in bounds[m - 1::m]])

    def search(k):
        passed = F.size(F.filter(coarse, lambda b: b <= k)) * m
        return F.transform(F.array(passed), lambda p: p + F.size(F.filter(F.slice(every, p + 1, m), lambda b: b <= k)))[0]

    return F.transform(F.array(F.struct(*names)), search)[0]


def in_pieces(df: DataFrame, order, num_partitions: int | None = None, then=()) -> DataFrame:
    """``df`` in range partitions of the ascending columns ``order``, sorted in
    each, rows of the same order by the columns ``then``. The bounds come from the order's columns alone (written once as a
    narrow table), so the other columns are computed once: Spark's own range
    exchange draws its sample from the full rows and then computes them again.
    A sample of bounded size and the bounds pass the driver."""
    from tessera.session import scratch_path
    spark, cols = df.sparkSession, _order_cols(order)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_k{i}" for i in range(len(cols))]
    path = scratch_path(spark, "order-keys")
    df.select(*[x.alias(n) for x, n in zip(cols, names)]).write.parquet(path)
    keys = spark.read.parquet(path)
    keyed = df.select("*", *[x.alias(n) for x, n in zip(cols, names)])
    piece = _piece_of(names, keys.schema, _bounds(keys, names, num_partitions))
    return keyed.repartitionById(num_partitions, piece).sortWithinPartitions(*names, *then).drop(*names)


def laid_out(df: DataFrame, order, value: str, num_partitions: int | None = None,
             run_of: str | None = None) -> DataFrame:
    """Rows in range partitions of ``order``, written once to the scratch
    folder with their place: ``_piece`` (partition), ``_row`` (number in it)
    and ``_cum`` (sum of the non-null integer ``value`` over earlier rows of
    the piece). With ``run_of`` (a non-null integer column that ``order`` begins
    with) also ``_place``: the row's number among the piece's rows of the same
    value. Each task counts over its own sorted rows; nothing but the
    exchange of :func:`in_pieces` is shuffled. Wide columns are computed, moved
    and written once."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    from tessera.session import scratch_path
    spark = df.sparkSession
    places = ["_piece", "_row", "_cum", *(["_place"] if run_of else [])]

    def run(batches):
        piece, row, total, now, seen = TaskContext.get().partitionId(), 0, 0, None, 0
        for b in batches:
            x = np.asarray(b.column(value))
            sums = np.cumsum(x)
            added = [pa.array(np.full(len(x), piece), pa.int32()), pa.array(row + np.arange(len(x)), pa.int64()),
                     pa.array(total + sums - x, pa.int64())]
            if run_of and len(x):
                v, i = np.asarray(b.column(run_of)), np.arange(len(x))
                new = np.r_[v[0] != now, v[1:] != v[:-1]]
                start = np.maximum.accumulate(np.where(new, i, -seen))
                now, seen = v[-1], int(len(x) - start[-1])
                added.append(pa.array(i - start, pa.int64()))
            elif run_of:
                added.append(pa.array([], pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, *places])
            row, total = row + len(x), total + (int(sums[-1]) if len(x) else 0)

    schema = df.select("*", *[F.lit(None).cast("int" if n == "_piece" else "bigint").alias(n) for n in places]).schema
    path = scratch_path(spark, "laid-out")
    in_pieces(df, order, num_partitions).mapInArrow(run, schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def prefix_sum(df: DataFrame, order, value: str, out: str = "cum", inclusive: bool = True,
               num_partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` along a total ``order`` without a one-partition window.

    Range-partition on the order; the sum of every earlier partition comes
    from a per-partition table (one row per partition, broadcast); inside a
    partition a window over ``_pid`` adds the local running sum. The ranges
    are balanced by sampling, so the window groups are too.
    """
    cols = _order_cols(order)
    ranged = _ranged(df, cols, num_partitions)
    sums = ranged.groupBy("_pid").agg(F.sum(value).alias("_s"))
    offsets = sums.select("_pid", F.coalesce(
        F.sum("_s").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    frame = Window.partitionBy("_pid").orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    local = F.coalesce(F.sum(value).over(frame), F.lit(0))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + local).drop("_pid", "_off"))


def max_before(df: DataFrame, by, order, value: str, out: str = "prior_max",
               num_partitions: int | None = None) -> DataFrame:
    """Maximum of ``value`` over all earlier rows of the same ``by`` group
    (same scheme as :func:`min_before`, via negation)."""
    neg = df.withColumn("_neg", -F.col(value))
    r = min_before(neg, by, order, "_neg", "_pmin", num_partitions)
    return r.withColumn(out, -F.col("_pmin")).drop("_neg", "_pmin")


def min_before(df: DataFrame, by, order, value: str, out: str = "prior_min",
               num_partitions: int | None = None) -> DataFrame:
    """Minimum of ``value`` over all earlier rows of the same ``by`` group.

    Same two-level scheme as :func:`prefix_sum`: range partitions on
    ``(by, order)`` so one hot group spreads over many partitions; the
    minimum of the earlier partitions of each group comes from a summary with
    one row per (partition, group); the in-partition part is a window over
    ``(_pid, by)``.
    """
    by = [by] if isinstance(by, str) else list(by)
    cols = [F.col(b) for b in by] + _order_cols(order)
    ranged = _ranged(df, cols, num_partitions)
    summary = ranged.groupBy("_pid", *by).agg(F.min(value).alias("_m"))
    prior = summary.select("_pid", *by, F.min("_m").over(
        Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_pm"))
    frame = Window.partitionBy("_pid", *by).orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(prior, ["_pid", *by])
            .withColumn(out, F.least(F.col("_pm"), F.min(value).over(frame)))
            .drop("_pid", "_pm"))
