"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

A document is contaminated by a benchmark item when some stretch of it is
within ``(1 - SIMILARITY)`` of the item's words in edit distance (insert,
delete, replace a word; words without case and punctuation).

Method. Texts become symbols: the benchmark's words are numbered, all other
words are symbol 0, which equals no item word. Items are classed by length,
and windows of each class's size start at every word of a document. A CGK
random walk reads a window: at step ``j`` it writes the symbol it stands on
and moves on by a random bit of (``j``, symbol). Windows within a small edit
distance so become strings of small Hamming distance. Bit sampling LSH looks
at ``SAMPLES`` steps of the walk at a time; windows that agree with an item
there are candidates, and a banded-free exact edit distance (free ends in the
document) decides. Walks and samples are repeated until a simulated set of
items with as many edits as allowed reaches ``RECALL``; the number is found
on the items themselves, for each class. Walks of very long items seldom meet
again after many edits: a class that ``MOST_TABLES`` tables don't bring to
``RECALL`` is searched exactly by seeds besides (an item with e edits keeps one
of e + 1 pieces whole), and every candidate goes through the same edit distance.

Windows in which more words are foreign to all items of the class than an item
may have edits can't match, and are passed over before the walk; this loses
nothing.

The benchmark is a query set that every document is held against. It is taken
in blocks of bounded size (``BLOCK_WORDS`` words, one broadcast each), each task
has one block in memory at a time, and documents are read once. Nothing is
shuffled and no text or candidate leaves its task.

Defined results: null and empty texts, and texts shorter than an item allows,
are clean; an item of fewer than ``LEAST_WORDS`` words allows no edits and says
nothing about a longer text, so it is found in the texts that are that item as
a whole; null items and items without a word are found nowhere; equal items each get their own hit; a tie
at the largest distance is a hit; repeated rows give repeated results; extra
columns pass through ``clean``; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import table

SIMILARITY = 0.8
RECALL = 0.98
LEAST_WORDS = 5
SAMPLES = 3
PER_WALK = 8
MOST_TABLES = 512
CLASS_RATIO = 1.15
BLOCK_WORDS = 2_000_000
REGION_CELLS = 1 << 21
TEXT_BYTES = 8 << 20

_PLAIN = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
_MARKS = re.compile(rb"\xe2\x80[\x80-\xbf]|\xc2[\xa0\xab\xbb]")


def words_of(text: str | None) -> list[bytes]:
    """Words without case, ASCII punctuation and typographic marks."""
    raw = (text or "").lower().encode()
    if b"\xe2\x80" in raw or b"\xc2" in raw:
        raw = _MARKS.sub(b" ", raw)
    return raw.translate(_PLAIN).split()


def allowed(words: int) -> int:
    """The most edits of an item of so many words."""
    return int(words * (1 - SIMILARITY) + 1e-9)


def walk_keys(x: np.ndarray, starts: np.ndarray, steps: int, bits: np.ndarray, picks: np.ndarray, base: int) -> np.ndarray:
    """One CGK walk from each start of ``x`` (which ends in enough zeros):
    keys (tables, starts) of the symbols at the picked steps."""
    at, seen = starts.copy(), {}
    wanted = set(picks.reshape(-1).tolist())
    for j in range(steps):
        s = x[at]
        if j in wanted:
            seen[j] = s.astype(np.int64)
        at += (bits[j >> 6][s] >> np.uint64(j & 63)) & np.uint64(1) == 1
    keys = []
    for row in picks.tolist():
        key = np.zeros(len(starts), np.int64)
        for j in row:
            key = key * base + seen[j]
        keys.append(key)
    return np.stack(keys)


def distances(items: np.ndarray, sizes: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Least edit distance of each item (row, padded by -1) to any stretch of
    its region (row, padded by -2)."""
    wide = np.arange(regions.shape[1] + 1)
    line = np.zeros((len(items), len(wide)), np.int32)
    out = np.zeros(len(items), np.int64)
    for j in range(items.shape[1] + 1):
        done = sizes == j
        if done.any():
            out[done] = line[done].min(axis=1)
        if j == items.shape[1]:
            break
        same = regions == items[:, j:j + 1]
        new = np.empty_like(line)
        new[:, 0] = line[:, 0] + 1
        new[:, 1:] = np.minimum(line[:, 1:] + 1, line[:, :-1] + 1 - same)
        line = np.minimum.accumulate(new - wide, axis=1) + wide
    return out


def seed_keys(x: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` symbols from each place on."""
    key = np.zeros(max(len(x) - size + 1, 0), np.uint64)
    for j in range(size):
        key = (key + x[j:j + len(key)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


class Block:
    """A block of benchmark items, ready for the search."""

    def __init__(self, items: list[tuple[object, list[bytes]]], seed: int = 1):
        self.ids = [i for i, _ in items]
        self.symbols: dict[bytes, int] = {}
        self.short: dict[tuple, list[int]] = {}
        for i, (_, ws) in enumerate(items):
            if len(ws) < LEAST_WORDS:
                self.short.setdefault(tuple(ws), []).append(i)
        coded = [np.array([self.symbols.setdefault(w, len(self.symbols) + 1) for w in ws], np.int32) for _, ws in items]
        self.base = len(self.symbols) + 1
        self.sizes = np.array([len(x) for x in coded])
        self.most = int(self.sizes.max())
        self.coded = np.full((len(coded), self.most), -1, np.int32)
        for row, x in zip(self.coded, coded):
            row[:len(x)] = x
        self.classes = []
        rng = np.random.default_rng(seed)
        todo = np.argsort(self.sizes, kind="stable")
        todo = todo[self.sizes[todo] >= LEAST_WORDS]
        while len(todo):
            low = int(self.sizes[todo[0]])
            mine = todo[self.sizes[todo] <= max(low, int(low * CLASS_RATIO))]
            todo = todo[len(mine):]
            self.classes.append(self._class(mine, low, int(self.sizes[mine].max()), rng))

    def _class(self, mine: np.ndarray, low: int, high: int, rng) -> dict:
        steps = 2 * low
        flat = np.concatenate([np.r_[self.coded[i][:self.sizes[i]], np.zeros(steps, np.int32)] for i in mine]).astype(np.int32)
        starts = np.r_[0, np.cumsum(self.sizes[mine] + steps)[:-1]]
        trials = [self._edited(mine[i % len(mine)], rng) for i in range(max(200, len(mine)) if len(mine) < 1000 else 1000)]
        edited = np.concatenate([np.r_[x, np.zeros(steps, np.int32)] for x in trials]).astype(np.int32)
        from_ = np.r_[0, np.cumsum([len(x) + steps for x in trials])[:-1]]
        truth = np.arange(len(trials)) % len(mine)
        walks, found, tables = [], np.zeros(len(trials), bool), 0
        while tables < MOST_TABLES and found.mean() < RECALL:
            bits = rng.integers(0, 2**63, (steps // 64 + 1, self.base), np.int64).astype(np.uint64)
            picks = np.stack([rng.choice(steps, SAMPLES, replace=False) for _ in range(PER_WALK)])
            keys = walk_keys(flat, starts, steps, bits, picks, self.base)
            found |= (walk_keys(edited, from_, steps, bits, picks, self.base) == keys[:, truth]).any(axis=0)
            order = np.argsort(keys, axis=1, kind="stable")
            walks.append((bits, picks, np.take_along_axis(keys, order, 1), mine[order]))
            tables += PER_WALK
        own = np.zeros(self.base, bool)
        own[flat] = True
        own[0] = False
        recall = float(found.mean()) if tables else 0.0
        return {"low": low, "own": own, "edits": allowed(high), "steps": steps, "walks": walks, "recall": recall,
                "seeds": self._seeds(mine) if recall < RECALL else None}

    def _seeds(self, mine: np.ndarray) -> tuple:
        """Length of a seed, and sorted hashes of all pieces with their items and places."""
        pieces = [allowed(int(self.sizes[i])) + 1 for i in mine]
        size = min(int(self.sizes[i]) // n for i, n in zip(mine, pieces))
        item = np.repeat(mine, pieces)
        place = np.concatenate([np.arange(n) * int(self.sizes[i]) // n for i, n in zip(mine, pieces)])
        key = np.concatenate([seed_keys(self.coded[i][:self.sizes[i]], size)[place[item == i]] for i in mine])
        order = np.argsort(key, kind="stable")
        return size, key[order], item[order], place[order]

    def _seeded(self, x: np.ndarray, total: int, seeds: tuple) -> np.ndarray:
        """Candidates (item, place of a seed's hit, first and end of the region to look at)."""
        size, known, items, places = seeds
        key = seed_keys(x[:total + size], size)[:total]
        low = np.searchsorted(known, key)
        at = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == key)
        n = np.searchsorted(known, key[at], side="right") - low[at]
        which = np.repeat(low[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        hit, item = np.repeat(at, n), items[which]
        # hits whose stretches begin within a run of as many words as there may be edits share a region
        run = (self.sizes[item] * (1 - SIMILARITY) + 1e-9).astype(np.int64) + 1
        group = (hit - places[which]) // run
        _, one = np.unique(np.stack([item, group, self._text_of(hit)]), axis=1, return_index=True)
        item, group, run, hit = item[one], group[one], run[one], hit[one]
        return np.stack([item, hit, (group - 1) * run, (group + 2) * run + self.sizes[item] + run])

    def _edited(self, item: int, rng) -> np.ndarray:
        """The item with as many random edits as allowed."""
        x = self.coded[item][:self.sizes[item]].tolist()
        for _ in range(allowed(len(x))):
            kind, at = rng.integers(3), int(rng.integers(len(x)))
            new = int(rng.integers(self.base)) if rng.random() < 0.5 else 0
            if kind == 0:
                x[at] = new
            elif kind == 1:
                x.insert(at, new)
            else:
                del x[at]
        return np.array(x, np.int32)

    def search(self, texts: list[list[bytes]]) -> list[tuple[int, int, int]]:
        """(text, item, distance) of all hits."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        total = int(sizes.sum())
        x = np.zeros(total + 2 * self.most + 2, np.int32)
        x[:total] = np.fromiter(map(self.symbols.get, itertools.chain.from_iterable(texts), itertools.repeat(0)), np.int32, total)
        self._ends = ends = np.cumsum(sizes)
        found = []
        for c in self.classes:
            foreign = np.r_[0, np.cumsum(~c["own"][x], dtype=np.int32)]
            starts = np.flatnonzero(foreign[c["low"]:total + c["low"]] - foreign[:total] <= c["edits"])
            pairs = []
            for bits, picks, keys, items in c["walks"]:
                for key, known, item in zip(walk_keys(x, starts, c["steps"], bits, picks, self.base), keys, items):
                    low = np.searchsorted(known, key)
                    hit = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == key)
                    if len(hit):
                        low = low[hit]
                        n = np.searchsorted(known, key[hit], side="right") - low
                        which = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                        pairs.append(np.unique(item[which] * (total + 1) + np.repeat(starts[hit], n)))
            if pairs:
                item, start = np.divmod(np.unique(np.concatenate(pairs)), total + 1)
                edits = (self.sizes[item] * (1 - SIMILARITY) + 1e-9).astype(np.int64)
                # the stretch may begin so many words before or after the window's start
                found.append(np.stack([item, start, start - edits, start + self.sizes[item] + 2 * edits]))
            if c["seeds"] is not None and total:
                found.append(self._seeded(x, total, c["seeds"]))
        best = {(a, b): 0 for a, ws in enumerate(texts) if self.short and len(ws) < LEAST_WORDS and ws
                for b in self.short.get(tuple(ws), [])}
        if found:
            self._verify(x, np.concatenate(found, axis=1), best)
        return [(a, b, n) for (a, b), n in sorted(best.items())]

    def _text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self._ends, place, side="right")

    def _verify(self, x: np.ndarray, found: np.ndarray, best: dict) -> None:
        """Exact distances of candidates, as many regions at once as REGION_CELLS allow."""
        found = found[:, np.argsort(self.sizes[found[0]], kind="stable")]
        starts = np.r_[0, self._ends]
        at = 0
        while at < found.shape[1]:
            widest = int((found[3] - found[2])[at:at + 4096].max())
            some = found[:, at:at + min(4096, max(1, REGION_CELLS // widest))]
            at += some.shape[1]
            i, t = some[0], self._text_of(some[1])
            size = self.sizes[i]
            edits = (size * (1 - SIMILARITY) + 1e-9).astype(np.int64)
            first, last = np.maximum(some[2], starts[t]), np.minimum(some[3], self._ends[t])
            place = first[:, None] + np.arange(int((last - first).max()))
            regions = np.where(place < last[:, None], x[np.minimum(place, len(x) - 1)], -2)
            d = distances(self.coded[i][:, :size.max()], size, regions)
            for a, b, n in zip(t[d <= edits].tolist(), i[d <= edits].tolist(), d[d <= edits].tolist()):
                best[a, b] = min(n, best.get((a, b), n))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list:
    """The benchmark in broadcast blocks of at most BLOCK_WORDS words (an item is never cut)."""
    sc, out, held, size = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(id_col, text_col).orderBy(id_col, text_col)
    for name, text in rows.toLocalIterator():
        words = words_of(text)
        if not words:
            continue
        held.append((name, words))
        size += len(words)
        if size >= BLOCK_WORDS:
            out.append(sc.broadcast(Block(held)))
            held, size = [], 0
    if held:
        out.append(sc.broadcast(Block(held)))
    return out


def one_by_one(held: list) -> Iterator[Block]:
    """The blocks; with several, one is given back before the next is loaded."""
    for h in held:
        yield h.value
        if len(held) > 1:
            h.__dict__.pop("_value", None)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hits: array of item and distance, sorted by item) for every row; clean rows have no hits."""
    held = blocks(benchmark)
    kind = docs.schema[id_col].dataType
    item_kind = benchmark.schema["item_id"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits: list[list[tuple[str, int]]] = [[] for _ in range(len(b))]
            for start, end in text_blocks(b["text"].tolist()):
                texts = [words_of(t) for t in b["text"].iloc[start:end]]
                for block in one_by_one(held):
                    for text, item, d in block.search(texts):
                        name = block.ids[item]
                        hits[start + text].append((None if name is None else str(name), d))
            yield pd.DataFrame({"id": b["id"], "items": [[i for i, _ in h] for h in hits],
                                "distances": [[d for _, d in h] for h in hits]})

    narrow = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    found = narrow.mapInPandas(run, "id string, items array<string>, distances array<bigint>")
    hits = F.array_sort(F.transform(F.arrays_zip("items", "distances"), lambda h: F.struct(
        h["items"].cast(item_kind).alias("item_id"), h["distances"].alias("distance"))))
    return found.select(F.col("id").cast(kind).alias(id_col), hits.alias("hits"))


def text_blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TEXT_BYTES characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= TEXT_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, all columns as they were. The search
    passes rows through, so nothing is joined."""
    held = blocks(benchmark)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column("text").to_pylist()
            good = np.ones(len(texts), bool)
            for start, end in text_blocks(texts):
                words = [words_of(t) for t in texts[start:end]]
                for block in one_by_one(held):
                    for text, _, _ in block.search(words):
                        good[start + text] = False
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: whether contaminated, by which items, at which distance."""
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("bigint").alias("n_items"),
                        F.transform("hits", lambda h: h["item_id"]).alias("items"),
                        F.transform("hits", lambda h: h["distance"]).alias("distances"))
