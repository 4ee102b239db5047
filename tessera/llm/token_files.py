"""Token ids in files, coded by Simple-8b.

Code. A 64-bit word has a 4-bit selector and 60 bits of ids: selector ``s``
holds ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits, from the lowest bits on.
Selector 0 is an escape: the next word is one id of over 60 bits as it is.
Ids are cut into blocks of ``BLOCK`` ids; words never cross a block, and the
offset of each block's first word is stored, so that all blocks of a segment
are packed and unpacked side by side on arrays, one word of each per step.

File format. A token file is a Parquet folder (written by Spark, so it can
lie in any store that Spark writes) whose rows are segments: ``part`` and
``seq`` (their order), ``before`` (ids of the part before the segment),
``doc_ids`` and ``n_tokens`` (its documents in order), ``n_ids``, ``offsets``
(little-endian 32-bit) and ``words`` (little-endian 64-bit). Parts follow
the order of document ids, so documents are in ascending order of id (ties by
a hash of the text), nulls first.

Encoding. Units are words, those of letters only without the punctuation at
their end, and such punctuation. They are kept with their ids, and the library
encodes only those that a worker hasn't met: the vocabulary drops white space
and ends its tokens at word ends, so a text's ids are its units' ids in a row.
Texts with special tokens go to the library whole. Known units are bounded
in number.

Defined results: a null text is empty (only the end id); repeated rows are
written as often as they occur; extra columns are ignored; an empty table
gives an empty file. Nothing is collected but the number of ids of each part.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import gather, partitions, scratch, table, text_blocks

BLOCK = 128
#: Fixed: ids per word and bits per id, by selector (0: escape).
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_POWERS = np.array([1 << i for i in range(60)], np.uint64)
TEXT_BYTES = 2 << 20
KEPT_WORDS = 600_000
FIRST_WORDS = 200_000


_SHORT_WIDTHS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id; 64 for those over 60 bits."""
    if ids.max() < len(_SHORT_WIDTHS):
        return _SHORT_WIDTHS[ids.astype(np.int64)]
    width = np.searchsorted(_POWERS, ids, side="right").astype(np.uint8)
    width[ids >= 1 << 60] = 64
    return width


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offset of each block's first word) of unsigned ids."""
    ids = np.asarray(ids, np.uint64)
    rows = -(-len(ids) // BLOCK)
    if not rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    grid = np.zeros(rows * BLOCK, np.uint64)
    grid[:len(ids)] = ids
    held = np.full(rows, BLOCK)
    held[-1] = len(ids) - (rows - 1) * BLOCK
    # widest id of the next 1, 2, 3, ... ids; behind a block's end all fits
    widest = np.zeros((rows, BLOCK + COUNTS.max()), np.uint8)
    widest[:, :BLOCK] = _widths(grid).reshape(rows, BLOCK)
    of = {1: widest.reshape(-1)}
    choice = np.zeros(widest.size, np.uint8)
    few = None  # places that fit, once they are few: what doesn't fit a selector doesn't fit a lower one
    for s in range(len(COUNTS) - 1, 0, -1):
        n = int(COUNTS[s])
        if few is not None:
            few = few[(of[1][few[:, None] + np.arange(n)] <= WIDTHS[s]).all(1)]
            choice[few] = s
            continue
        if n > 1:
            half = max(k for k in of if k <= n and 2 * k >= n)
            of[n] = of[half].copy()
            np.maximum(of[half][:len(choice) - (n - half)], of[half][n - half:], out=of[n][:len(choice) - (n - half)])
        fits = of[n] <= WIDTHS[s]
        np.copyto(choice, np.uint8(s), where=fits)
        fits = fits.reshape(rows, -1)[:, :BLOCK]
        if np.count_nonzero(fits) < fits.size >> 6:
            row, at = np.nonzero(fits)
            few = row * widest.shape[1] + at
    choice = choice.reshape(rows, -1)
    # one word of every block per step
    at, row, steps = np.zeros(rows, np.int64), np.arange(rows), []
    while len(row):
        s = choice[row, at[row]]
        n = np.minimum(COUNTS[s], held[row] - at[row])
        steps.append((row * BLOCK + at[row], s, n))
        at[row] += n
        row = row[at[row] < held[row]]
    start, selector, count = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(start)
    start, selector, count = start[order], selector[order], count[order]
    size = np.where(selector == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        mine = selector == s
        if s == 0:
            words[place[mine] + 1] = grid[start[mine]]
            continue
        value, own, n = np.full(int(mine.sum()), s << 60, np.uint64), start[mine], count[mine]
        for j in range(n.max()):
            there = n > j
            if there.all():
                value |= grid[own + j] << np.uint64(j * WIDTHS[s])
            else:
                value[there] |= grid[own[there] + j] << np.uint64(j * WIDTHS[s])
        words[place[mine]] = value
    return words, place[np.searchsorted(start, np.arange(rows) * BLOCK)].astype(np.uint32)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids of :func:`pack`'s result."""
    rows = len(offsets)
    if not rows:
        return np.empty(0, np.uint64)
    held = np.full(rows, BLOCK, np.int64)
    held[-1] = n - (rows - 1) * BLOCK
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector == 0).any():
        # escaped ids may look like any word: step through all blocks side by side
        word, at, row, steps = offsets.astype(np.int64), np.zeros(rows, np.int64), np.arange(rows), []
        while len(row):
            s = selector[word[row]]
            steps.append((word[row], row * BLOCK + at[row], np.minimum(COUNTS[s], held[row] - at[row])))
            word[row] += np.where(s == 0, 2, 1)
            at[row] += COUNTS[s]
            row = row[at[row] < held[row]]
        word, start, count = (np.concatenate(x) for x in zip(*steps))
    else:
        word = np.arange(len(words))
        count = COUNTS[selector]
        ends = np.r_[offsets[1:].astype(np.int64), len(words)]
        # the last word of a block may hold fewer ids than its selector says
        total = np.add.reduceat(count, offsets.astype(np.int64))
        count[ends - 1] -= total - held
        start = np.cumsum(count) - count
    out = np.zeros(n, np.uint64)
    kind = selector[word]
    for s in np.unique(kind).tolist():
        mine = kind == s
        if s == 0:
            out[start[mine]] = words[word[mine] + 1]
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        value, place, size = words[word[mine]], start[mine], count[mine]
        for j in range(COUNTS[s]):
            there = j < size
            if there.all():
                out[place + j] = (value >> np.uint64(j * WIDTHS[s])) & mask
            else:
                out[place[there] + j] = (value[there] >> np.uint64(j * WIDTHS[s])) & mask
    return out


class _Known(dict):
    """Numbers words in the order in which they come."""

    def __init__(self, names: list):
        self.names = names

    def __missing__(self, key):
        self[key] = code = len(self.names)
        self.names.append(key)
        return code


class WordEncoder:
    """Encodes texts through the ids of their words (see the module's text)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        ends = [i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]
        self.ends = np.zeros(max(self.library.get_vocab().values()) + 1, bool)
        self.ends[ends] = True
        self.merges = self._merges(path)
        self.tried: set[str] = set()
        self.split: set[str] = set()
        self.names: list[bytes] = []
        self.known = _Known(self.names)
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)

    def _merges(self, path: str):
        """The library without normalizer and pre-tokenizer, for pieces of
        small ASCII letters; None if these two change such pieces."""
        from tokenizers import Tokenizer
        letters = "abcdefghijklmnopqrstuvwxyz"
        bare, steps = Tokenizer.from_file(path), (self.library.normalizer, self.library.pre_tokenizer)
        if steps[0] is not None and steps[0].normalize_str(letters) != letters:
            return None
        if steps[1] is None or [t for t, _ in steps[1].pre_tokenize_str(letters)] != [letters]:
            return None
        bare.normalizer, bare.pre_tokenizer = None, None
        return bare

    def _letters(self, cores: list[str]) -> np.ndarray:
        """Which cores are letters only for the library too: its normalizer may
        turn a letter into one and a mark, which joins punctuation that
        follows. Each character is tried once."""
        new = set().union(*map("".join, (cores[i:i + 4096] for i in range(0, len(cores), 4096)))) - self.tried
        self.tried |= new
        self.split |= {x for x in new if x.isalpha() and not self.library.normalizer.normalize_str(x).isalpha()}
        plain = np.fromiter(map(str.isalpha, cores), bool, len(cores))
        if self.split:
            plain &= np.fromiter(map(self.split.isdisjoint, cores), bool, len(cores))
        return plain

    def _pieces(self, pieces: list[str], bare: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are one pre-token each: the library gets many
        at once, and each ends with the only token that ends a word. ``bare``:
        they are small ASCII letters only."""
        ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(pieces), 2000):
            part = pieces[at:at + 2000]
            if bare:
                got = self.merges.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)
            else:
                got = self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            got = np.array(got[0].ids, np.int32)
            stop = np.flatnonzero(self.ends[got]) + 1
            if len(stop) != len(part):  # some piece is more than one pre-token
                got, stop = self._each(part)
                stop = np.cumsum(stop)
            ids.append(got)
            sizes.append(np.diff(np.r_[0, stop]))
        return np.concatenate(ids), np.concatenate(sizes)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that the library gets one by one."""
        each = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for e in each for i in e], np.int32), np.array([len(e) for e in each], np.int64)

    def _learn(self) -> None:
        """Ids of the units that came since the last call."""
        units = self.names[len(self.sizes):]
        bare = np.fromiter(map(bytes.isalpha, units), bool, len(units)) if self.merges is not None else np.zeros(len(units), bool)
        other = [units[i].decode() for i in np.flatnonzero(~bare).tolist()]
        of = self._letters(other)
        letters = np.zeros(len(units), bool)
        letters[~bare] = of
        got = [self._pieces([units[i].decode() for i in np.flatnonzero(bare).tolist()], True),
               self._pieces([w for w, x in zip(other, of.tolist()) if x], False),
               self._each([w for w, x in zip(other, of.tolist()) if not x])]
        owner = np.concatenate([np.flatnonzero(bare), np.flatnonzero(letters), np.flatnonzero(~bare & ~letters)])
        flat, every = (np.concatenate(x) for x in zip(*got))
        place = np.argsort(owner, kind="stable")
        self.flat = np.r_[self.flat, gather(flat, every, place)]
        self.sizes = np.r_[self.sizes, every[place]]

    def _forget(self) -> None:
        del self.names[FIRST_WORDS:]
        for w in [w for w, c in self.known.items() if c >= FIRST_WORDS]:
            del self.known[w]
        self.sizes = self.sizes[:FIRST_WORDS].copy()
        self.flat = self.flat[:self.sizes.sum()].copy()

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """(words of each text, each word's number, the distinct words, their
        numbers of ids, their ids). Texts are split and words told apart by
        Arrow, so that each distinct word is looked up once."""
        if len(self.names) > KEPT_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        every = lists.values
        there = pc.greater(pc.binary_length(every), 0)  # white space at a text's ends leaves empty words
        numbers = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))]
        per_text = np.diff(numbers[lists.offsets.to_numpy()])
        coded = every.filter(there).dictionary_encode()
        names = coded.dictionary
        cores = pc.ascii_rtrim(names, characters=".,;:!?")
        plain = pc.ascii_is_alpha(cores).to_numpy(zero_copy_only=False).astype(bool)
        rest = np.flatnonzero(~plain)
        plain[rest] = self._letters([c.decode() for c in self._bytes(cores.take(pa.array(rest)))])
        whole = self._bytes(names)
        units = self._bytes(pc.if_else(pa.array(plain), cores, names))
        size = pc.binary_length(cores).to_numpy()
        tailed = np.flatnonzero(plain & (size < pc.binary_length(names).to_numpy()))
        tails = [whole[i][n:] for i, n in zip(tailed.tolist(), size[tailed].tolist())]
        get = self.known.__getitem__
        used = np.fromiter(map(get, units), np.int64, len(units))
        tails = np.fromiter(map(get, tails), np.int64, len(tails))
        self._learn()
        sizes = self.sizes[used]
        sizes[tailed] += self.sizes[tails]
        return per_text, coded.indices.to_numpy(), whole, sizes, gather(self.flat, self.sizes, np.insert(used, tailed + 1, tails))

    @staticmethod
    def _bytes(words: pa.Array) -> list[bytes]:
        """Words without white space as Python's bytes."""
        kind = words.type
        spaced = pc.binary_join_element_wise(words, pa.scalar("", kind), pa.scalar(" ", kind))
        return spaced.buffers()[2].to_pybytes().split(b" ")[:-1] if len(words) else []

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        # a text that may hold a special token, which is cut out before anything else
        whole = {i: self.library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if t and "<|" in t}
        per_text, codes, _, each, flat = self.words(["" if i in whole else t or "" for i, t in enumerate(texts)])
        ids = gather(flat, each, codes)
        sizes = np.bincount(np.repeat(np.arange(len(texts)), per_text), each[codes], len(texts)).astype(np.int64)
        if whole:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, own in whole.items():
                parts[i], sizes[i] = np.array(own, np.int32), len(own)
            ids = np.concatenate(parts)
        return ids, sizes


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def library_encoder(path: str) -> Callable:
    """An encoder for :func:`write`: of the word-end vocabulary at ``path``."""
    return lambda: word_encoder(path).encode


def write(docs: DataFrame, to: str, encoder: Callable, end_id: int, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write the ids of all documents, each followed by ``end_id``, to the folder ``to``."""
    kind = docs.schema[id_col].dataType.simpleString()
    tie = F.xxhash64(text_col)
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), tie.alias("tie"))
               .repartitionByRange(partitions(docs), "id", "tie").sortWithinPartitions("id", "tie", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before, encode = TaskContext.get().partitionId(), 0, 0, encoder()
        for b in batches:
            for start, end in text_blocks(b.column("text"), TEXT_BYTES):
                ids, sizes = encode(b.column("text").slice(start, end - start).to_pylist())
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                words, offsets = pack(ids)
                names = b.column("id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                    pa.ListArray.from_arrays([0, end - start], names), pa.array([(sizes + 1).tolist()], pa.list_(pa.int32())),
                    pa.array([len(ids)], pa.int64()), pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                    pa.array([words.astype("<u8").tobytes()], pa.binary())],
                    ["part", "seq", "before", "doc_ids", "n_tokens", "n_ids", "offsets", "words"])
                seq, before = seq + 1, before + len(ids)

    ordered.select("id", "text").mapInArrow(
        run, f"part int, seq int, before bigint, doc_ids array<{kind}>, n_tokens array<int>, n_ids bigint, "
             "offsets binary, words binary").write.parquet(to)


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids) of each document of a token file; with
    ``digest`` the CRC-32 of the ids as little-endian 32-bit numbers instead
    of the ids. ``start`` counts the ids of all documents before it."""
    stored = spark.read.parquet(path)
    kind = stored.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i] for c in b.schema.names}
                sizes = np.array(row["n_tokens"].as_py(), np.int64)
                ids = unpack(np.frombuffer(row["words"].as_buffer(), "<u8"), np.frombuffer(row["offsets"].as_buffer(), "<u4"),
                             row["n_ids"].as_py())
                ends = np.cumsum(sizes)
                first = row["before"].as_py() + ends - sizes
                if digest:
                    raw = memoryview(ids.astype("<u4")).cast("B")
                    last = pa.array([zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(sizes), row["part"].as_py()), pa.int32()), row["doc_ids"].values,
                    pa.array(first, pa.int64()), pa.array(sizes, pa.int64()), last], ["part", "id", "first", "n_tokens", "last"])

    last = "bigint" if digest else "array<bigint>"
    docs = stored.select("part", "before", "doc_ids", "n_tokens", "n_ids", "offsets", "words").mapInArrow(
        run, f"part int, id {kind.simpleString()}, first bigint, n_tokens bigint, last {last}")
    # a row per part: as many as the writer had shuffle partitions
    sums = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(offset), "part").select(
        "id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", F.col("last").alias("ids_crc32" if digest else "ids"))


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents as ids of the word-end vocabulary, written to a token file and read back."""
    import public_tokenizers
    path = scratch(spark, "token-file")
    write(table(spark, sf_dir, "documents"), path, library_encoder(public_tokenizers.path("word_bpe_49k.json")), end_id=1)
    return read(spark, path, digest=True).withColumnRenamed("id", "doc_id")
