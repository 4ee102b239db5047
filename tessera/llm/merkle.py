"""Merkle manifest of a dataset by time-forward processing.

A tree's nodes carry labels ``(level, place)``. Swept in label order, a node
finds its children's digests at the head of a priority queue, which its
children filled when their turn came; it hashes them and sends the result to
its parent's label. Swept in reversed order, a node finds the proof suffix
that its parent left (the siblings from there up to the root) and sends each
child that suffix with the child's sibling in front; what reaches a leaf is
its whole proof.

The queue is external: labels are cut into ranges of ``SPAN`` places
(subtrees of ``log2(SPAN)`` levels). Between ranges, messages are rows that
Spark shuffles and sorts by label; within a range a heap holds them, at most
``2 * SPAN`` at a time. A sweep over n leaves takes log(n) / log(SPAN) rounds,
each one ``SPAN`` times smaller than the one below, whatever the number or
size of the trees: a tree that holds every row spreads over all tasks.

Leaves are the rows of ``documents``: a hash of each column's byte length and
value. A language's leaves form a tree, and the roots of the languages one
more, by the same functions.

Results in special cases: a null value counts as ``-`` (an empty one as
``0:``); null languages form a tree of their own, before all others; rows of a
null doc_id come first in their tree and are never tampered with; rows that
share a doc_id follow in the order of their leaves; repeated rows are leaves
of their own; texts of any length are hashed whole; an empty table gives no
rows. Columns beside those named are left out of the leaves.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, numbered, table

SPAN = 512
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def forward(leaves: list[str], height: int) -> list[list[str]]:
    """Digests of a subtree by level, its leaves first."""
    levels: list[list[str]] = [[] for _ in range(height + 1)]
    queue = [(0, i, 0, d) for i, d in enumerate(leaves)]
    while queue:
        level, place, _, d = heappop(queue)
        if level:
            parts = [d]
            while queue and queue[0][:2] == (level, place):
                parts.append(heappop(queue)[3])
            d = digest(parts)
        levels[level].append(d)
        if level < height:
            heappush(queue, (level + 1, place // 2, place % 2, d))
    return levels


def backward(levels: list[list[str]], suffix: str) -> list[str]:
    """The proof of each leaf of a subtree whose root has the proof ``suffix``.

    A proof is a row of steps from the leaf up: ``L`` or ``R`` (the side the
    sibling stands on) and its digest, or ``-`` where there is none."""
    queue = [(1 - len(levels), 0, suffix)]
    out = [""] * len(levels[0])
    heapify(queue)
    while queue:
        level, place, suffix = heappop(queue)
        level = -level
        if level == 0:
            out[place] = suffix
            continue
        below = levels[level - 1]
        left, right = 2 * place, 2 * place + 1
        if right < len(below):
            heappush(queue, (1 - level, left, "R" + below[right] + suffix))
            heappush(queue, (1 - level, right, "L" + below[left] + suffix))
        else:
            heappush(queue, (1 - level, left, "-" + suffix))
    return out


def steps(proof: str) -> list[tuple[str, str]]:
    """The (side, sibling) steps of a proof; the sibling of ``-`` is empty."""
    out, at = [], 0
    while at < len(proof):
        n = 0 if proof[at] == "-" else 64
        out.append((proof[at], proof[at + 1:at + 1 + n]))
        at += 1 + n
    return out


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    for side, sibling in proof:
        leaf = digest([sibling, leaf] if side == "L" else [leaf, sibling])
    return leaf


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(n_chars: Column) -> Column:
    return F.sha2(F.concat(*[field(n_chars if name == "n_chars" else F.col(name)) for name in FIELDS]), 256)


def tree_of(name: str) -> Column:
    """A key that is never null and sorts as the column does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


class Forest:
    """Trees over ``leaves`` (tree, pos from 0 without gaps, digest, further columns)."""

    def __init__(self, leaves: DataFrame, span: int = SPAN):
        self.span = span
        self.levels = [leaves]
        most = leaves.agg(F.max("pos")).first()[0]
        while most is not None and most >= (1 if len(self.levels) > 1 else 0):
            self.levels.append(materialise(self._up(self.levels[-1]), "merkle-up"))
            most //= span

    def roots(self) -> DataFrame:
        """tree, digest"""
        return self.levels[-1].select("tree", "digest")

    def _up(self, nodes: DataFrame) -> DataFrame:
        """The digests of all ranges; the first range of a tree is told the
        tree's size, as a tree of one range ends at its root."""
        sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
        rows = nodes.select("tree", F.floor(F.col("pos") / self.span).alias("range"), "pos", "digest",
                            F.lit(None).cast("long").alias("size"))
        told = sizes.select("tree", F.lit(0).cast("long").alias("range"), F.lit(-1).cast("long").alias("pos"),
                            F.lit(None).cast("string").alias("digest"), "size")
        span = self.span

        def run(group: pa.Table) -> pa.Table:
            group = group.sort_by("pos")
            digests = group["digest"].to_pylist()
            height = (span - 1).bit_length()
            if group["pos"][0].as_py() < 0:
                digests = digests[1:]
                height = min(height, (group["size"][0].as_py() - 1).bit_length())
            return pa.table({"tree": group["tree"][:1], "pos": group["range"][:1],
                             "digest": forward(digests, height)[height], "height": pa.array([height], pa.int32())})

        return rows.unionByName(told).groupBy("tree", "range").applyInArrow(
            run, "tree string, pos long, digest string, height int")

    def proofs(self, top: DataFrame, emit, schema: str) -> DataFrame:
        """Sweep back from the roots. ``top`` holds each tree's own proof suffix
        and further columns to hand down (tree, suffix, ...). ``emit`` turns the
        rows of one range of leaves, their proofs and the range's message into
        the result, a table of ``schema``."""
        carried = [c for c in top.columns if c not in ("tree", "suffix")]
        message = (self.levels[-1].join(top, "tree").select("tree", "pos", "height", "suffix", *carried)
                   if len(self.levels) > 1 else None)
        for i in range(len(self.levels) - 2, -1, -1):
            nodes = self.levels[i]
            own = [c for c in nodes.columns if c not in ("tree", "pos", "digest")]
            rows = nodes.select("tree", F.floor(F.col("pos") / self.span).alias("range"), "pos", "digest",
                                F.struct(*own).alias("row") if own else F.lit(None).cast("struct<none:int>").alias("row"))
            told = message.select("tree", F.col("pos").alias("range"), F.lit(-1).cast("long").alias("pos"),
                                  F.struct("height", "suffix", *carried).alias("message"))
            both = rows.unionByName(told, allowMissingColumns=True).groupBy("tree", "range")
            if i == 0:
                return both.applyInArrow(_leaves(emit), schema)
            kept = ", ".join(f"{c} {top.schema[c].dataType.simpleString()}" for c in carried)
            message = materialise(both.applyInArrow(
                _inner(carried), "tree string, pos long, height int, suffix string" + (", " + kept if kept else "")),
                "merkle-down")
        return top.sparkSession.createDataFrame([], schema)


def _opened(group: pa.Table) -> tuple[pa.Table, list[str], dict]:
    """A range's nodes in order, their proofs, and the message it got."""
    group = group.sort_by("pos")
    message = group["message"][0].as_py()
    nodes = group.slice(1)
    return nodes, backward(forward(nodes["digest"].to_pylist(), message["height"]), message["suffix"]), message


def _inner(carried: list[str]):
    def run(group: pa.Table) -> pa.Table:
        nodes, proofs, message = _opened(group)
        heights = [r["height"] for r in nodes["row"].to_pylist()]
        return pa.table({"tree": nodes["tree"], "pos": nodes["pos"], "height": pa.array(heights, pa.int32()),
                         "suffix": proofs, **{c: [message[c]] * len(proofs) for c in carried}})
    return run


def _leaves(emit):
    def run(group: pa.Table) -> pa.Table:
        return emit(*_opened(group))
    return run


def manifest(docs: DataFrame, tampered: Column | None = None, span: int = SPAN) -> DataFrame:
    """One row a document: leaf, subroot of its language, root, its proof, and
    the root folded from the proof and the leaf, or from the leaf of
    ``n_chars + 1`` where ``tampered`` holds."""
    again = leaf(F.col("n_chars") + 1)
    changed = F.when(tampered & F.col("n_chars").isNotNull(), again) if tampered is not None else F.lit(None)
    leaves = materialise(docs.select(tree_of("lang").alias("tree"), "doc_id", leaf(F.col("n_chars")).alias("digest"),
                                     changed.cast("string").alias("changed")), "merkle-leaves")
    forest = Forest(materialise(numbered(leaves, ["doc_id", "digest"]), "merkle-order"), span)
    tops = forest.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    over = Forest(materialise(numbered(tops, ["name"]), "merkle-tops"), span)
    root = over.roots().select("tree", F.lit("").alias("suffix"), F.col("digest").alias("root"))

    def tops_out(nodes: pa.Table, proofs: list[str], message: dict) -> pa.Table:
        names = [r["name"] for r in nodes["row"].to_pylist()]
        return pa.table({"tree": names, "suffix": proofs, "subroot": nodes["digest"],
                         "root": [message["root"]] * len(names)})

    messages = materialise(over.proofs(root, tops_out, "tree string, suffix string, subroot string, root string"),
                           "merkle-down")

    def leaves_out(nodes: pa.Table, proofs: list[str], message: dict) -> pa.Table:
        rows, n = nodes["row"].to_pylist(), len(proofs)
        path = [steps(p) for p in proofs]
        folded = [fold(r["changed"] or d, p) for r, d, p in zip(rows, nodes["digest"].to_pylist(), path, strict=True)]
        return pa.table({
            "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "leaf": nodes["digest"],
            "subroot": [message["subroot"]] * n, "root": [message["root"]] * n,
            "proof": proofs, "proof_sha256": [digest([s for _, s in p]) for p in path], "folded_root": folded,
            "verified": [f == message["root"] for f in folded]})

    return forest.proofs(messages, leaves_out, "doc_id long, leaf string, subroot string, root string, proof string, "
                                               "proof_sha256 string, folded_root string, verified boolean")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, one in seven tampered with, and its verdicts."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    return manifest(table(spark, sf_dir, "documents"), chosen).drop("proof")


def oracle(levels: int = 24) -> str:
    """The same in SQL, for up to 2 ** ``levels`` rows a tree and as many trees."""
    part = {c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS}
    more = {**part, "n_chars": part["n_chars"].replace("n_chars", "(n_chars + 1)")}
    up, both = [], (("d", "lang"), ("t", "1"))
    for name, key in both:
        for k in range(1, levels + 1):
            up.append(f"""{name}{k} AS MATERIALIZED (SELECT tree, pos // 2 AS pos,
                CASE WHEN any_value(size) = 1 THEN any_value(dg) ELSE sha256(string_agg(dg, '' ORDER BY pos)) END AS dg,
                (any_value(size) + 1) // 2 AS size, any_value(size) > 1 AS hashed
              FROM {name}{k - 1} GROUP BY tree, pos // 2)""")
        if name == "d":
            up.append(f"""t0 AS MATERIALIZED (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS pos,
                dg, count(*) OVER () AS size FROM d{levels})""")
    path = " UNION ALL ".join(
        [f"""SELECT x.tree, x.pos, {k} AS step, s.dg, s.pos < (x.pos >> {k}) AS before
             FROM d0 x JOIN d{k + 1} p ON p.tree = x.tree AND p.pos = x.pos >> {k + 1} AND p.hashed
             LEFT JOIN d{k} s ON s.tree = x.tree AND s.pos = xor(x.pos >> {k}, 1)""" for k in range(levels)]
        + [f"""SELECT x.name, -1, {levels + k}, s.dg, s.pos < (x.pos >> {k})
             FROM t0 x JOIN t{k + 1} p ON p.pos = x.pos >> {k + 1} AND p.hashed
             LEFT JOIN t{k} s ON s.pos = xor(x.pos >> {k}, 1)""" for k in range(levels)])
    return f"""
    WITH RECURSIVE bits AS (SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS n FROM range(256) r(i)
      UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM bits WHERE n < 8),
    crc AS (SELECT list(v ORDER BY i) AS l FROM bits WHERE n = 8),
    leaves AS (SELECT coalesce('=' || lang, '') AS tree, doc_id,
        sha256({' || '.join(part[c] for c in FIELDS)}) AS dg, sha256({' || '.join(more[c] for c in FIELDS)}) AS again,
        n_chars IS NOT NULL AND doc_id IS NOT NULL AND xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
          lambda a, b: xor(a >> 8, crc.l[(xor(a, b) & 255) + 1]))) % 7 = 0 AS chosen
      FROM documents, crc),
    d0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, dg) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS size FROM leaves),
    {', '.join(up)},
    path AS ({path}),
    upper AS (SELECT tree, list(struct_pack(s := dg, b := before) ORDER BY step) AS l FROM path WHERE pos = -1 GROUP BY tree),
    lower AS (SELECT tree, pos, list(struct_pack(s := dg, b := before) ORDER BY step) AS l FROM path WHERE pos >= 0
      GROUP BY tree, pos),
    whole AS (SELECT d0.*, list_concat(coalesce(lower.l, []), coalesce(upper.l, [])) AS l
      FROM d0 LEFT JOIN lower ON lower.tree = d0.tree AND lower.pos = d0.pos LEFT JOIN upper ON upper.tree = d0.tree),
    folds AS (SELECT tree, pos, 0 AS n, CASE WHEN chosen THEN again ELSE dg END AS h, l FROM whole
      UNION ALL SELECT tree, pos, n + 1, sha256(CASE WHEN l[n + 1].s IS NULL THEN h
          WHEN l[n + 1].b THEN l[n + 1].s || h ELSE h || l[n + 1].s END), l FROM folds WHERE n < len(l))
    SELECT w.doc_id, w.dg AS leaf, t0.dg AS subroot, top.dg AS root,
      sha256(array_to_string(list_filter(list_transform(w.l, lambda x: x.s), lambda x: x IS NOT NULL), '')) AS proof_sha256,
      f.h AS folded_root, f.h = top.dg AS verified
    FROM whole w JOIN folds f ON f.tree = w.tree AND f.pos = w.pos AND f.n = len(w.l)
    JOIN t0 ON t0.name = w.tree, t{levels} top"""
