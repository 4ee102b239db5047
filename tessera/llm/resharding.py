"""Resharding by minimum-cost flow.

Given the sizes of the old shards and the capacities of the new ones, a
minimum-cost flow says how many bytes go from each old shard to each new one
(keeping a byte in place is free, moving it costs one), so the fewest bytes
move. Flows become block transfers: the documents of an old shard, in order
of id, are cut into blocks at the flow's amounts. Cuts fall between
documents, so shards miss their capacities by a few documents; a bounded pool
of documents of each shard (``POOL``, known to the driver) is then used to
even that out by moving or exchanging single documents, always to the better.
Only shards that gain or lose documents are rewritten.

What the driver holds is bounded by the numbers of shards and ``POOL``: shard
sizes, block borders and the moved pool documents. Documents find their shard
from the borders alone, so texts are moved once, when the new files are
written, spread by (shard, id) over all tasks however large a shard is.

Files: a Parquet folder ``shard=N`` per rewritten shard; ``piece`` and
``place`` give the order of rows, from which slots are counted.

Defined results: a null text has no bytes; a null id sorts first; repeated
rows are told apart by their place in the input files (or by ``tie``); an
empty table gives no rows; extra columns are written too, unless their names
are used here, and don't matter.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, scratch, table

ROW_BYTES = 16
POOL = 256


def flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Amounts from each source to each sink at the least total cost
    (successive shortest paths with potentials; ``sum(supply) <= sum(capacity)``)."""
    n, m = len(supply), len(capacity)
    sent = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    high = [0] * (n + m)  # potentials keep reduced costs from falling below zero
    while any(left):
        far = [float("inf")] * (n + m)
        via = [-1] * (n + m)
        queue = []
        for i in range(n):
            if left[i]:
                far[i] = 0
                heapq.heappush(queue, (0, i))
        while queue:
            d, v = heapq.heappop(queue)
            if d > far[v]:
                continue
            arcs = ((n + j, cost[v][j]) for j in range(m)) if v < n else (
                (i, -cost[i][v - n]) for i in range(n) if sent[i][v - n])
            for w, c in arcs:
                x = d + c + high[v] - high[w]
                if x < far[w]:
                    far[w], via[w] = x, v
                    heapq.heappush(queue, (x, w))
        sink = min((n + j for j in range(m) if room[j]), key=lambda v: (far[v] + high[v], v))
        for v in range(n + m):
            high[v] += min(far[v], far[sink])
        path = [sink]
        while via[path[-1]] >= 0:
            path.append(via[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[sink - n], *(
            sent[b][a - n] for a, b in zip(path, path[1:]) if a >= n))
        for a, b in zip(path, path[1:]):
            if a < n:
                sent[a][b - n] += amount
            else:
                sent[b][a - n] -= amount
        left[path[0]] -= amount
        room[sink - n] -= amount
    return sent


def even(total: int, shards: int) -> list[int]:
    """Capacities that differ by one at most."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def repair(size: dict[int, int], capacity: list[int], pool: dict[int, list[tuple[int, object]]],
           rounds: int = 4000) -> dict[object, int]:
    """Moves and exchanges of pool documents (size, name) between the fullest
    and the emptiest shard, as long as they come closer to their capacities."""
    over = {j: size.get(j, 0) - c for j, c in enumerate(capacity)}
    held = {j: sorted(pool.get(j, []), key=lambda x: (x[0], str(x[1]))) for j in over}
    where: dict[object, int] = {}
    for _ in range(rounds):
        a = max(over, key=lambda j: (over[j], j))
        b = min(over, key=lambda j: (over[j], j))
        gap = over[a] - over[b]
        if gap <= 1:
            break
        # what changes hands should be half the gap: one document, or the difference of two
        best = None
        for back in [(0, None), *held[b][:: max(1, len(held[b]) // 64)]]:
            at = bisect.bisect_left(held[a], back[0] + gap // 2, key=lambda x: x[0])
            for give in held[a][max(0, at - 1):at + 1]:
                shift = give[0] - back[0]
                if 0 < shift < gap and (best is None or abs(2 * shift - gap) < best[0]):
                    best = (abs(2 * shift - gap), give, back)
        if best is None:
            break
        _, give, back = best
        held[a].remove(give)
        bisect.insort(held[b], give, key=lambda x: x[0])
        where[give[1]] = b
        if back[1] is not None:
            held[b].remove(back)
            bisect.insort(held[a], back, key=lambda x: x[0])
            where[back[1]] = a
        over[a] -= give[0] - back[0]
        over[b] += give[0] - back[0]
    return where


def running(df: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    """``df`` with ``sum_before``: the total of ``value`` over the earlier
    rows of the same ``by`` (a non-null int) in ``order``. One range exchange;
    a hot ``by`` is spread over many partitions, whose sums are carried on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, carry = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            key, x = np.asarray(b.column(by)), np.asarray(b.column(value))
            before = np.cumsum(x) - x
            first = np.r_[True, key[1:] != key[:-1]]
            local = before - np.maximum.accumulate(np.where(first, before, 0))
            if key[0] == last:
                local[key == last] += carry
            carry, last = int(local[-1] + x[-1]), key[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(key), piece), pa.int32()),
                                              pa.array(local, pa.int64())], [*b.schema.names, "piece", "local"])

    ranged = df.repartitionByRange(partitions(df), by, *order).sortWithinPartitions(by, *order)
    schema = df.withColumn("piece", F.lit(None).cast("int")).withColumn("local", F.lit(None).cast("bigint")).schema
    done = materialise(ranged.mapInArrow(run, schema), "running")
    # at most one row for each partition and each ``by``
    sums = done.groupBy("piece", by).agg(F.sum(value).alias("n"))
    earlier = Window.partitionBy(by).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("piece", by, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return done.join(F.broadcast(carry), ["piece", by]).withColumn(
        "sum_before", F.col("base") + F.col("local")).drop("piece", "local", "base")


def located(docs: DataFrame) -> DataFrame:
    """``docs``, as read from files, with ``tie``: a number of the row's place in them."""
    return docs.withColumn("tie", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def size_of(text: str = "text"):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def _key(docs: DataFrame, id_col: str):
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    return F.coalesce(F.col(id_col).cast("bigint") if whole else F.xxhash64(id_col), F.lit(-(1 << 63)).cast("bigint"))


def plan(docs: DataFrame, shards: int, id_col: str = "doc_id", capacity: list[int] | None = None,
         cost=lambda old, new: int(old != new)) -> dict:
    """Where each document goes, from columns ``old`` (its shard) and ``tie``:
    block borders by old shard, the pool documents moved one by one, and the
    new shards that change."""
    narrow = running(docs.select(F.col("old").cast("int"), _key(docs, id_col).alias("key"), "tie", size_of().alias("size")),
                     "old", ["key", "tie"], "size")
    sizes = {r["old"]: r["n"] for r in narrow.groupBy("old").agg(F.sum("size").alias("n")).collect()}
    olds = sorted(sizes)
    capacity = capacity or even(sum(sizes.values()), shards)
    sent = flow([sizes[i] for i in olds], capacity, [[cost(i, j) for j in range(shards)] for i in olds])
    cuts, goal = {}, {}
    for i, row in zip(olds, sent):
        goal[i] = [j for j in range(shards) if row[j]]
        cuts[i] = np.cumsum([row[j] for j in goal[i]])[:-1].tolist()
    spark = docs.sparkSession
    if not olds:
        return {"borders": {}, "moves": {}, "changed": [], "sent": sent, "capacity": capacity}
    # a row per old shard
    lists = F.broadcast(spark.createDataFrame([(i, cuts[i], goal[i]) for i in olds], "old int, cuts array<bigint>, goal array<int>"))
    placed = narrow.join(lists, "old").withColumn("block", F.size(F.filter(
        "cuts", lambda c: 2 * c <= 2 * F.col("sum_before") + F.col("size")))).withColumn("shard", F.col("goal")[F.col("block")])
    blocks = placed.groupBy("old", "block", "shard").agg(
        F.min(F.struct("key", "tie")).alias("first"), F.sum("size").alias("n")).collect()
    borders, filled = {i: [] for i in olds}, {}
    for r in sorted(blocks, key=lambda r: (r["old"], r["block"])):
        borders[r["old"]].append((r["first"]["key"], r["first"]["tie"], r["shard"]))
        filled[r["shard"]] = filled.get(r["shard"], 0) + r["n"]
    pick = Window.partitionBy("shard").orderBy(F.xxhash64("tie"), "key", "tie")
    pool: dict[int, list] = {}
    for r in placed.withColumn("n", F.row_number().over(pick)).where(F.col("n") <= POOL).select(
            "old", "shard", "key", "tie", "size").collect():
        pool.setdefault(r["shard"], []).append((r["size"], (r["key"], r["tie"], r["old"])))
    moves = repair(filled, capacity, pool)
    at = {name: j for j, docs_ in pool.items() for _, name in docs_}
    moves = {name: j for name, j in moves.items() if j != at[name]}
    changed = {j for i in olds for _, _, j in borders[i] if j != i}
    changed |= {i for i in olds if i < shards and any(j != i for _, _, j in borders[i])}
    changed |= {j for name, to in moves.items() for j in (to, at[name])}
    return {"borders": borders, "moves": moves, "changed": sorted(changed), "sent": sent, "capacity": capacity}


def assign(docs: DataFrame, plan_: dict, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard``: read off the plan row by row, nothing is shuffled."""
    spark = docs.sparkSession
    borders = spark.createDataFrame(
        [(i, [(k, t) for k, t, _ in b], [j for _, _, j in b]) for i, b in plan_["borders"].items()],
        "old int, firsts array<struct<key:bigint,tie:bigint>>, goals array<int>")
    moves = spark.createDataFrame([(*name, j) for name, j in plan_["moves"].items()], "_key bigint, tie bigint, old int, moved int")
    keyed = docs.withColumn("old", F.col("old").cast("int")).withColumn("_key", _key(docs, id_col))
    block = F.size(F.filter("firsts", lambda f: (f["key"] < F.col("_key")) | (
        (f["key"] == F.col("_key")) & (f["tie"] <= F.col("tie")))))
    return (keyed.join(F.broadcast(borders), "old").join(F.broadcast(moves), ["_key", "tie", "old"], "left")
            .withColumn("shard", F.coalesce("moved", F.element_at("goals", F.greatest(block, F.lit(1)))))
            .drop("firsts", "goals", "moved"))


def rewrite(assigned: DataFrame, to: str) -> None:
    """Write documents with their ``shard`` to files ``shard=N`` in order of id."""
    ranged = (assigned.repartitionByRange(partitions(assigned), "shard", "_key", "tie")
              .sortWithinPartitions("shard", "_key", "tie"))
    (ranged.drop("_key", "tie", "old").withColumn("piece", F.spark_partition_id())
     .withColumn("place", F.monotonically_increasing_id()).write.partitionBy("shard").parquet(to))


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of rewritten shards with their ``slot``: counted over the shard's
    files from the rows of each piece (a small table: pieces and shards)."""
    rows = spark.read.schema(schema).parquet(path)
    parts = rows.groupBy("shard", "piece").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("shard", "piece", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), ["shard", "piece"]).withColumn(
        "slot", F.col("base") + F.col("place") - F.col("low")).drop("piece", "place", "low", "base")


def reshard(docs: DataFrame, shards: int, id_col: str = "doc_id", **more) -> DataFrame:
    """``docs`` (with ``old`` and ``tie``) in their new shards: the rewritten
    ones read back from their files, the unchanged ones as they are; columns
    ``shard`` and ``slot`` are added."""
    spark = docs.sparkSession
    made = plan(docs, shards, id_col, **more)
    assigned = assign(docs, made, id_col)
    path = scratch(spark, "shards")
    moved = F.col("shard").isin(made["changed"]) if made["changed"] else F.lit(False)
    rewrite(assigned.where(moved), path)
    schema = assigned.drop("_key", "tie", "old", "shard").withColumn("piece", F.lit(None).cast("int")).withColumn(
        "place", F.lit(None).cast("bigint")).withColumn("shard", F.lit(None).cast("int")).schema
    done = read(spark, path, schema)
    rest = running(assigned.where(~moved).withColumn("_one", F.lit(1).cast("bigint")), "shard", ["_key", "tie"], "_one") if len(
        made["changed"]) < shards else None
    if rest is None:
        return done
    return done.unionByName(rest.withColumnRenamed("sum_before", "slot").drop("_one", "_key", "tie", "old"))


def op2_resharding(spark, sf_dir: str) -> DataFrame:
    """All documents from 32 shards by source (sizes very uneven) into 40 of equal bytes."""
    docs = located(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "tie", F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(32)).cast("int").alias("old"))
    done = reshard(docs, 40)
    return done.select("doc_id", size_of().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
