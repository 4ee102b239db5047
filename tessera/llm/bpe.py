"""Byte-level BPE encoding and decoding with a pair occurrence index.

Method. The distinct pre-tokens of a block of texts of one partition are laid
out in one sequence of symbols. An index maps each adjacent pair that the
vocabulary can merge to all its positions in that sequence. The active ranks
are taken in ascending order; a rank's merge is applied at all positions of
its pair at once (left to right), and the lists of the pairs to the left and
right of each merge are updated. A merge only makes pairs of higher rank, as a
vocabulary's merges use symbols that earlier merges made, so this equals
merging each pre-token on its own. Texts are then assembled from their
pre-tokens' ids on arrays.

The vocabulary is a ``tokenizers`` JSON file of a byte-level BPE without
normaliser (``path`` is a parameter; the file is read on the executors, never
copied). Its added tokens are cut out of the text first, as the library does.
Each partition works alone: nothing is shuffled, collected or broadcast, and a
lost task is simply run again. Blocks have bounded bytes, and ids of
pre-tokens are kept between blocks up to a bounded number.

Defined results: a null text is empty and has no ids; decoding replaces
invalid UTF-8 by U+FFFD; repeated rows give repeated results; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import gather, ranges, table, text_blocks

#: Fixed: the pattern of byte-level pre-tokenisation.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SPACES = re.compile(r"\s\s")
BLOCK_BYTES = 6 << 20
#: A worker that knows more units keeps the first of them, which are the frequent ones.
KEPT_UNITS = 450_000
FIRST_UNITS = 200_000
#: Characters of new units merged at once, and ids decoded at once: the lists
#: and arrays of both are many times their size.
MERGED_CHARS, DECODED_IDS = 1 << 18, 1 << 18


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merges and token bytes of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], byte_symbols()
        ids = model["vocab"]
        value = {s: bytes([b]) for b, s in enumerate(symbols)}
        self.byte_ids = np.array([ids[s] for s in symbols], np.int64)
        #: by rank: the pair and what it becomes
        self.made = [(ids[a], ids[b], ids[a + b]) for a, b in (
            p if isinstance(p, list) else p.split(" ") for p in model["merges"])]
        self.ranks = {a << 32 | b: rank for rank, (a, b, _) in enumerate(self.made)}
        self.pair_keys = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[k] for k in self.pair_keys.tolist()], np.int64)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        cut = "|".join(re.escape(t) for t in sorted(self.added, key=lambda t: (-len(t), t)))
        self.cut = re.compile(f"({cut})") if cut else None
        names = {i: b"".join(value[c] for c in s) for s, i in ids.items() if all(c in value for c in s)}
        names.update({i: s.encode() for s, i in self.added.items()})
        size = np.zeros(max(names) + 2, np.int64)
        for i, b in names.items():
            size[i + 1] = len(b)
        self.offsets = np.cumsum(size)
        self.bytes = np.frombuffer(b"".join(names.get(i, b"") for i in range(len(size) - 1)), np.uint8)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_all(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``words`` in a row, and the number of ids of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    first = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.arange(1, total + 1)
    after[ends[lengths > 0] - 1] = -1
    before = np.arange(-1, total - 1)
    before[(ends - lengths)[lengths > 0]] = -1
    # the index: positions of each rank's pair
    where: list[list[int] | None] = [None] * len(vocab.made)
    pairs = first[:-1] << 32 | first[1:]
    found = np.searchsorted(vocab.pair_keys, pairs)
    found[found == len(vocab.pair_keys)] = 0
    at = np.flatnonzero((vocab.pair_keys[found] == pairs) & (after[:-1] >= 0)) if total and len(vocab.pair_keys) else np.empty(0, np.int64)
    ranks = vocab.pair_ranks[found[at]]
    order = np.argsort(ranks, kind="stable")
    present, cuts = np.unique(ranks[order], return_index=True)
    active = present.tolist()  # sorted, so a heap
    for rank, places in zip(active, np.split(at[order], cuts[1:])):
        where[rank] = places.tolist()

    symbol, left, right = first.tolist(), before.tolist(), after.tolist()
    rank_of, push = vocab.ranks.get, heapq.heappush
    while active:
        rank = heapq.heappop(active)
        places, where[rank] = where[rank], None
        a, b, new = vocab.made[rank]
        lead = new << 32
        if a == b:
            places.sort()
        for p in places:
            q = right[p]
            if symbol[p] != a or q < 0 or symbol[q] != b:
                continue  # an earlier merge took one of the two
            r, l = right[q], left[p]
            symbol[p], symbol[q], right[p] = new, -1, r
            if r >= 0:
                left[r] = p
                k = rank_of(lead | symbol[r])
                if k is not None:
                    if where[k] is None:
                        where[k] = [p]
                        push(active, k)
                    else:
                        where[k].append(p)
            if l >= 0:
                k = rank_of(symbol[l] << 32 | new)
                if k is not None:
                    if where[k] is None:
                        where[k] = [l]
                        push(active, k)
                    else:
                        where[k].append(l)
    ids = np.array(symbol, np.int32)
    live = ids >= 0
    return ids[live], np.bincount(np.repeat(np.arange(len(words)), lengths)[live], minlength=len(words))


class _Codes(dict):
    """Numbers keys in the order in which they come."""

    def __init__(self, units: list[str], lead: str):
        self.units, self.lead = units, lead

    def __missing__(self, key):
        self[key] = code = len(self.units)
        self.units.append(self.lead + key)
        return code


class Encoder:
    """Encodes blocks of texts. Units are strings that pre-tokenisation never
    joins with their neighbours: words with the space before them, line ends,
    or single pre-tokens."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.units: list[str] = []
        self.plain, self.spaced = _Codes(self.units, ""), _Codes(self.units, " ")
        self.unit_ids, self.unit_sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def forget(self, keep: int) -> None:
        """Keep the first ``keep`` units only."""
        del self.units[keep:]
        for codes in (self.plain, self.spaced):
            for unit in [u for u, c in codes.items() if c >= keep]:
                del codes[unit]
        self.unit_sizes = self.unit_sizes[:keep].copy()
        self.unit_ids = self.unit_ids[:self.unit_sizes.sum()].copy()

    def codes(self, text: str) -> list[int]:
        """Unit codes of a text; added tokens are ``-1 - id``."""
        if self.vocab.cut and self.vocab.cut.search(text):
            out: list[int] = []
            for i, part in enumerate(self.vocab.cut.split(text)):
                out += [-1 - self.vocab.added[part]] if i % 2 else self.codes(part)
            return out
        if _SPACES.search(text):
            return list(map(self.plain.__getitem__, PRETOKEN.findall(text)))
        # white space is single here, so a space goes with what follows and a line end stands alone
        out, end = [], self.plain["\n"]
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(end)
            first, *rest = line.split(" ")
            if first:
                out.append(self.plain[first])
            out += map(self.spaced.__getitem__, rest)
        return out

    def learn(self) -> None:
        """Ids of the units that came since the last call."""
        known = len(self.unit_sizes)
        every, counts = [self.unit_ids], [self.unit_sizes]
        for start, end in ranges(np.fromiter(map(len, self.units[known:]), np.int64), MERGED_CHARS):
            split = [PRETOKEN.findall(u) for u in self.units[known + start:known + end]]
            pieces: dict[str, int] = {}
            used = np.fromiter((pieces.setdefault(p, len(pieces)) for ps in split for p in ps), np.int64)
            ids, sizes = merge_all([p.encode() for p in pieces], self.vocab)
            owner = np.repeat(np.arange(len(split)), [len(ps) for ps in split])
            every.append(gather(ids, sizes, used))
            counts.append(np.bincount(owner, sizes[used], minlength=len(split)).astype(np.int64))
        self.unit_ids, self.unit_sizes = np.concatenate(every), np.concatenate(counts)
        self.units[known:] = [""] * (len(self.units) - known)  # only their number is needed from here on

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        if len(self.units) > KEPT_UNITS:
            self.forget(FIRST_UNITS)
        coded = [self.codes(t or "") for t in texts]
        self.learn()
        codes = np.fromiter((c for cs in coded for c in cs), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(cs) for cs in coded])
        special = codes < 0
        # added tokens are units after the known ones
        added = -1 - codes[special]
        names, place = np.unique(added, return_inverse=True)
        codes[special] = len(self.unit_sizes) + place
        sizes = np.r_[self.unit_sizes, np.ones(len(names), np.int64)]
        ids = gather(np.r_[self.unit_ids, names.astype(np.int32)], sizes, codes)
        return ids, np.bincount(owner, sizes[codes], minlength=len(texts)).astype(np.int64)


def decode_flat(ids: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> list[str]:
    """The texts of ids in a row; unknown ids have no bytes."""
    width = np.diff(vocab.offsets)
    ends = np.r_[0, np.cumsum(sizes)]
    texts: list[str] = []
    for start, end in ranges(sizes, DECODED_IDS):
        own, n = ids[ends[start]:ends[end]], sizes[start:end]
        known = (own >= 0) & (own < len(width))
        own, n = own[known], np.bincount(np.repeat(np.arange(len(n)), n)[known], minlength=len(n))
        raw = gather(vocab.bytes, width, own).tobytes()
        cuts = np.r_[0, np.cumsum(width[own])][np.r_[0, np.cumsum(n)]].tolist()
        texts += [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
    return texts


def _run(path: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder = Encoder(vocab)
        for b in batches:
            for start, end in text_blocks(b.column("text"), BLOCK_BYTES):
                ids, sizes = encoder.encode(b.column("text").slice(start, end - start).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(ids, pa.int32()))
                out = [b.column("name").slice(start, end - start), lists]
                if back:
                    out.append(pa.array(decode_flat(ids, sizes, vocab), pa.string()))
                yield pa.RecordBatch.from_arrays(out, ["name", "ids", "decoded"][:len(out)])
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(id, ids) of every row; with ``back`` also ``decoded``, the text that the ids decode to."""
    narrow = docs.select(F.col(id_col).alias("name"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = narrow.mapInArrow(_run(path, back), f"name {kind}, ids array<int>" + ", decoded string" * back)
    return out.withColumnRenamed("name", id_col)


def decode(coded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids (null ids: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            lists = b.column(ids_col)
            sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            texts = decode_flat(np.asarray(lists.flatten(), np.int64), sizes, vocab)
            mask = np.asarray(lists.is_null())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string(), mask=mask)], [*b.schema.names, out])

    return coded.mapInArrow(run, coded.withColumn(out, F.lit(None).cast("string")).schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of each document's ids, and digest of the text that they decode to."""
    both = encode(docs, path, back=True)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded by the byte-level vocabulary, and decoded again."""
    import public_tokenizers
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
