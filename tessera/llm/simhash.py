"""SimHash near-duplicates linked through BK-trees.

Each document's fingerprint is a majority vote over the 64-bit hashes of its
word shingles. Documents whose fingerprints differ in at most ``radius`` bits
are linked; ``components`` gives every document the smallest id that it can
reach.

Method. Equal fingerprints are collapsed first, so copies cost one node. A
fingerprint is cut into ``radius + 1`` blocks of bits: two fingerprints within
``radius`` bits agree on one block at least (pigeonhole), so each block value
is a shard that may be searched on its own and no link is lost. Each shard is
a BK-tree: the children of a node are keyed by their integer Hamming distance
to it, and a search from a node at distance ``d`` follows only the edges from
``d - radius`` to ``d + radius``. All trees of a task are built and searched
together, level by level, on arrays. A tree never leaves its task: only
shards of bounded size are made, in two steps for large ones. A shard with
more than ``max_shard`` members is split again by blocks of its remaining
bits (again exact), and what is still too large is split into chunks of which
every pair is searched. A task emits a spanning forest of the links that it
finds, so links grow with the nodes and not with their pairs.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; fewer words than a shingle hash as one sequence; repeated
rows give repeated results; a null id is kept, but never is a component's id
unless no other is there; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, partitions, table, union_all

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of one text (bit ``i`` is set when more than
    half of the shingle hashes have it)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = ends - sizes + 1
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], np.uint64)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for every row, in Arrow batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "fp": np.fromiter(
                (fingerprint(t, shingle) for t in b["text"]), np.int64, len(b))})

    # ids travel as strings of their own type inside the batch only if they are not whole numbers
    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (narrow.mapInPandas(run, "id string, fp bigint")
            .select(F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "fp"))


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of ``parts`` blocks that cover ``width`` bits."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(col, low: int, count: int):
    return F.shiftrightunsigned(col, low).bitwiseAND(F.lit((1 << count) - 1))


def _first_keys(nodes: DataFrame, radius: int) -> DataFrame:
    keys = [F.struct(F.lit(i).cast("bigint").alias("block"), _bits(F.col("fp"), low, n).alias("value"))
            for i, (low, n) in enumerate(_blocks(BITS, radius + 1))]
    return nodes.select("fp", F.inline(F.array(*keys)))


def _second_keys(rows: DataFrame, radius: int) -> DataFrame:
    """Keys for the members of large shards: blocks of the bits outside the shard's own block."""
    arms = []
    for i, (low, n) in enumerate(_blocks(BITS, radius + 1)):
        high = F.shiftleft(F.shiftrightunsigned("fp", low + n), low) if low + n < BITS else F.lit(0).cast("bigint")
        rest = high.bitwiseOR(_bits(F.col("fp"), 0, low)) if low else high
        arms.append(F.when(F.col("block") == i, F.array(*[
            F.struct(F.lit(j).cast("bigint").alias("sub"), _bits(rest, a, m).alias("subvalue"))
            for j, (a, m) in enumerate(_blocks(BITS - n, radius + 1))])))
    return rows.select("fp", "block", "value", F.inline(F.coalesce(*arms)))


def _forest(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all keys at once (rows sorted by key): for each row its
    tree's root, and the edges as sorted codes ``parent * 65 + distance`` with their children."""
    n = len(keys)
    first = np.r_[True, keys[1:] != keys[:-1]]
    root = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    at, todo = root.copy(), np.flatnonzero(~first)
    codes, children = [], []
    while len(todo):
        code = at[todo] * 65 + np.bitwise_count(fps[todo] ^ fps[at[todo]])
        order = np.argsort(code, kind="stable")
        code, todo = code[order], todo[order]
        new = np.r_[True, code[1:] != code[:-1]]
        child = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        codes.append(code[new])
        children.append(todo[new])
        at[todo] = child
        todo = todo[~new]
    code = np.concatenate(codes) if codes else np.empty(0, np.int64)
    child = np.concatenate(children) if children else np.empty(0, np.int64)
    order = np.argsort(code)
    return root, code[order], child[order]


def _links(keys: np.ndarray, fps: np.ndarray, radius: int, chunk: int = 4096) -> np.ndarray:
    """For each row the smallest row of the same key that it reaches by links of the key's tree."""
    root, codes, children = _forest(keys, fps)
    label = np.arange(len(keys))
    for at in range(0, len(keys), chunk):
        q = np.arange(at, min(at + chunk, len(keys)))
        node = root[q]
        while len(q):
            d = np.bitwise_count(fps[q] ^ fps[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            _unite(label, q[near], node[near])
            low = np.searchsorted(codes, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(codes, node * 65 + np.minimum(d + radius, 64), side="right")
            count = high - low
            q = np.repeat(q, count)
            node = children[np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(len(q))]
    return label


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of the rows ``a`` and ``b``; a label is a row of the same class, not above its own."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def links(nodes: DataFrame, radius: int = 4, max_shard: int = 2048) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints of ``nodes`` (distinct
    ``fp``) whose classes are those of all pairs within ``radius`` bits."""
    # level 1: at most (radius + 1) * 2^ceil(64 / (radius + 1)) shard keys exist, so this list has a fixed bound
    rows = _first_keys(nodes, radius)
    large = rows.groupBy("block", "value").count().where(F.col("count") > max_shard).select("block", "value")
    small = (rows.join(F.broadcast(large), ["block", "value"], "left_anti")
             .select("fp", F.xxhash64("block", "value").alias("key")))
    # level 2, counted again; what is still large is cut into chunks and searched by pairs of chunks
    second = _second_keys(rows.join(F.broadcast(large), ["block", "value"], "left_semi"), radius).select(
        "fp", F.xxhash64("block", "value", "sub", "subvalue").alias("key"))
    salts = 16
    sizes = second.groupBy("key").count().where(F.col("count") > max_shard).select(
        "key", F.ceil(F.col("count") / max_shard).cast("int").alias("chunks"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    sized = second.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(salts)).cast("int")).join(
        sizes, ["key", "salt"], "left")
    mine = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.xxhash64(
        F.lit("pair"), "key", F.least(mine, j), F.greatest(mine, j)))
    chunked = sized.select("fp", F.explode(F.when(F.col("chunks").isNull(), F.array("key")).otherwise(pairs)).alias("key"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(b["key"].to_numpy(np.int64), b["fp"].to_numpy(np.int64)) for b in batches]
        if not parts:
            return
        keys, fps = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((fps, keys))
        keys, fps = keys[order], fps[order].view(np.uint64)
        label = _links(keys, fps, radius)
        linked = label != np.arange(len(label))
        yield pd.DataFrame({"a": fps[linked].view(np.int64), "b": fps[label[linked]].view(np.int64)})

    spread = small.unionByName(chunked)
    return spread.repartition(partitions(nodes), "key").mapInPandas(search, "a bigint, b bigint")


def classes(edges: DataFrame, name: str = "star") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): connected
    components by alternating large and small stars. A round is written to
    the shared folder, and the number of rounds grows with the logarithm of
    the largest class."""
    edges = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every node's smaller neighbours, and the node itself, move to the smallest of them
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        moved = (star.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        new = materialise(moved, name)
        # done when each node has one edge and no root is a node: stars of depth one
        seen = new.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("d")).first()
        deep = new.join(new.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        if seen["n"] == seen["d"] and not deep:
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        edges = new


def components(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
               text_col: str = "text", max_shard: int = 2048) -> DataFrame:
    """(id, fp, component_id, size of the group of equal fingerprints) for every row."""
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    groups = materialise(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "groups")
    star = classes(links(groups.select("fp"), radius, max_shard))
    member = star.join(groups, star["node"] == groups["fp"]).select("fp", "root", "least")
    best = member.groupBy("root").agg(F.min("least").alias("best"))
    linked = member.join(best, "root").select("fp", "best")
    found = materialise(groups.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("best", "least").alias("component_id")), "classes")
    # at most 1000 fingerprints can hold more than a thousandth of all rows each
    total = fps.count()
    heavy = F.broadcast(found.where(F.col("n") * 1000 > total))
    light = found.where(F.col("n") * 1000 <= total)
    return union_all(fps.join(heavy, "fp"),
                     fps.join(heavy.select("fp"), "fp", "left_anti").join(light, "fp")).select(
        "id", "fp", "component_id", "n")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: the one with the
    smallest id (of several rows with that id, one). Rows without an id can't
    be named by a component, and stay."""
    columns = docs.columns
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = components(numbered, shingle, radius)
    keep = found.where("id = component_id").select("id").distinct()
    rows = (numbered.where("doc_id is not null").groupBy("doc_id").agg(F.min("_row").alias("_row"))
            .join(keep, F.col("doc_id") == F.col("id"), "left_semi").select("_row")
            .unionByName(numbered.where("doc_id is null").select("_row")))
    return numbered.join(rows, "_row", "left_semi").select(columns)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """SimHash of 4-word shingles over all documents, linked at 4 bits or fewer."""
    found = components(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
