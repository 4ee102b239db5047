"""Language-model scores from a small causal self-attention model.

Data. Texts are cut into words (A-Z lowered) once, and kept in a scratch table
of blocks of documents: each block has its distinct words (a 64-bit hash and
the ids of the word's pieces in a public vocabulary) and its documents as
numbers of these words. All later steps read that table.

Word counts of all training documents are summed by hash in Spark. They make
the unigram base score: frequent words (at least one in ``HEAD`` of all
tokens, so at most ``HEAD`` of them) are broadcast, the others are joined by
hash after being summed per document.

Model. A text is the ids of its words' pieces, and an end. The model predicts
the class of the next id (the most frequent ids are classes of their own, the
others share classes of about equal weight) from the ids before it, and then
the id within its class: a frequent id by its smoothed share after the last
id, any other by its share of the class's count. The class's logits are the
smoothed log share of the class after the last id, plus the output of one
causal self-attention head over the last ``WINDOW`` ids with learned
embeddings, projections and relative positions. Counts are exact sums over
all training documents. The attention is trained in numpy by Adam: in each of
``ROUNDS`` rounds every task goes over its training documents of that round
(each document has one) from the same parameters, and the parameters of all
tasks are averaged by their numbers of targets; so scores depend a little on
how the table of blocks is split into tasks. Every id and end of a training document is a target once; windows of
``WINDOW`` ids overlap by half, as in scoring.

Scoring. Windows of ``WINDOW`` ids overlap by half; the ids of the later half
are scored (each id once) with batched masked attention.

What the driver holds: the counts of the vocabulary's ids, the tables of shares
(``INPUTS`` by ``CLASSES`` and by ``OWN_INPUTS``) and the parameters, none of
which grows with the corpus.

Defined results: a null text is empty (one token: the end); without training
documents all counts are 0 and scores come from equal shares; a null id is
held out if the empty string were; repeated rows count as often as they occur;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import gather, materialise, table, text_blocks
from tessera.llm.token_files import WordEncoder

FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 3 << 19
HEAD = 1 << 22
END_WORD = -1  # the hash of the end; no word's hash is looked up for it
CLASSES, SINGLE_CLASSES = 64, 48
INPUTS, OWN_INPUTS = 2304, 2048
WIDTH, WINDOW = 16, 16
BATCH, RATE, ROUNDS = 256, 0.01, 3
SMOOTH, PAIR_SMOOTH = 5.0, 5.0


class Pieces(WordEncoder):
    """Numbers the words of a block and gives their hashes and pieces."""

    def block(self, texts: list[str | None]) -> tuple:
        """(words per text, word numbers, hashes, piece counts, pieces) with words numbered within the block."""
        sizes, codes, names, counts, ids = self.words([t or "" for t in texts])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names)).view(np.int64)
        return sizes, codes, hashes, counts, ids


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _code_kind(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<u4"


def blocks(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scratch table of blocks (see the module's text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for b in batches:
            for start, end in text_blocks(b.column("text"), BLOCK_BYTES):
                sizes, codes, hashes, counts, ids = known.block(b.column("text").slice(start, end - start).to_pylist())
                names = b.column("name").slice(start, end - start).to_pylist()
                held = [zlib.crc32((n or "").encode()) % FOLDS == HELD_OUT for n in names]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names], pa.list_(pa.string())), pa.array([held], pa.list_(pa.bool_())),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    *[pa.array([np.asarray(x).astype(t).tobytes()], pa.binary()) for x, t in (
                        (codes, _code_kind(len(hashes))), (hashes, "<i8"), (counts, "<u4"), (ids, "<u2"))]],
                    ["names", "held", "sizes", "codes", "hashes", "counts", "ids"])

    narrow = docs.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    out = narrow.mapInArrow(run, "names array<string>, held array<boolean>, sizes array<bigint>, codes binary, "
                                 "hashes binary, counts binary, ids binary")
    return materialise(out.withColumn("block", F.monotonically_increasing_id()), "word-blocks", compression="zstd")


class Block:
    """One row of the table of blocks."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def raw(name, kind):
            return np.frombuffer(batch.column(name)[row].as_buffer(), kind)
        self.names = batch.column("names")[row].as_py()
        self.held = np.array(batch.column("held")[row].as_py(), bool)
        self.sizes = np.array(batch.column("sizes")[row].as_py(), np.int64)
        self.hashes = raw("hashes", "<i8")
        self.codes = raw("codes", _code_kind(len(self.hashes))).astype(np.int64)
        self.counts, self.pieces = raw("counts", "<u4").astype(np.int64), raw("ids", "<u2")
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def ids(self, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the (chosen) documents in a row, and their numbers."""
        codes, owner = self.codes, self.owner
        if only is not None:
            codes, owner = codes[only[owner]], owner[only[owner]]
        sizes = np.bincount(owner, self.counts[codes], minlength=len(self.sizes)).astype(np.int64)
        return gather(self.pieces, self.counts, codes), sizes


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    pieces.cache_clear()  # a reused worker needn't keep the words of the first pass
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("block")[i].as_py(), Block(b, i)


def word_counts(held: DataFrame) -> DataFrame:
    """(hash, n): how often each word stands in training documents; the end has hash END_WORD."""
    def run(batches):
        for _, b in _each(batches):
            train = ~b.held
            n = np.bincount(b.codes[train[b.owner]], minlength=len(b.hashes))
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[b.hashes[own], END_WORD], pa.int64()),
                                              pa.array(np.r_[n[own], train.sum()], pa.int64())], ["hash", "n"])

    return held.mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")).where("n > 0")


_SUMS = "chunk bigint, at array<bigint>, x array<double>"


def _chunks(at: np.ndarray, x: np.ndarray, width: int) -> pa.RecordBatch:
    """Ascending cells and their values as a row for each ``width`` cells."""
    chunk = at // width
    first = np.flatnonzero(np.r_[len(chunk) > 0, chunk[1:] != chunk[:-1]])
    cuts = pa.array(np.r_[first, len(at)], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(chunk[first], pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(at, pa.int64())),
                                       pa.ListArray.from_arrays(cuts, pa.array(x, pa.float64()))], ["chunk", "at", "x"])


def _added(parts: DataFrame, size: int, width: int = 1 << 14) -> np.ndarray:
    """Element-wise sum of the tasks' :func:`_chunks`: chunks meet in Spark,
    and at most ``size`` numbers come to the driver."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            ends = np.asarray(b.column("at").offsets)
            at, x = np.asarray(b.column("at").values), np.asarray(b.column("x").values)
            for chunk, i, j in zip(b.column("chunk").to_pylist(), ends.tolist(), ends[1:].tolist()):
                more = np.bincount(at[i:j] - chunk * width, x[i:j], width)
                held[chunk] = held[chunk] + more if chunk in held else more
        for chunk, total in held.items():
            own = np.flatnonzero(total)
            yield _chunks(own + chunk * width, total[own], width)

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.repartition(n, "chunk").mapInArrow(run, _SUMS).toArrow()
    out = np.zeros(size)
    for at, x in zip(rows.column("at").chunks, rows.column("x").chunks):
        out[np.asarray(at.flatten())] = np.asarray(x.flatten())
    return out


def _summed(held: DataFrame, cells, size: int, at_once: int = 4 << 20, width: int = 1 << 14) -> np.ndarray:
    """How often each of ``size`` cells is named by ``cells(block)`` (arrays of
    cells, or pairs of cells and weights); tasks count their own blocks, Spark adds up."""
    def run(batches):
        total, keys, weights, n = np.zeros(size, np.int64), [], [], 0

        def add():
            if keys:
                w = np.concatenate(weights) if weights else None
                total[:] += np.bincount(np.concatenate(keys), w, size).astype(np.int64)
                keys.clear()
                weights.clear()

        for _, b in _each(batches):
            got = cells(b)
            if isinstance(got, tuple):
                weights.append(got[1])
                got = got[0]
            keys.append(got)
            n += len(got)
            if n >= at_once:
                add()
                n = 0
        add()
        own = np.flatnonzero(total)
        yield _chunks(own, total[own].astype(float), width)

    return _added(held.mapInArrow(run, _SUMS), size, width)


class Layout:
    """Classes of ids and their shares, and the inputs that ids are read as. ``end`` is the last id."""

    def __init__(self, counts: np.ndarray):
        self.end = len(counts) - 1
        order = np.lexsort((np.arange(len(counts)), -counts))
        weight = np.cumsum(counts[order] + 0.5)
        rest = weight - weight[SINGLE_CLASSES - 1]
        shared = SINGLE_CLASSES + np.minimum((rest / max(rest[-1], 1e-9) * (CLASSES - SINGLE_CLASSES)).astype(int),
                                             CLASSES - SINGLE_CLASSES - 1)
        self.cls = np.empty(len(counts), np.int64)
        self.cls[order] = np.where(np.arange(len(counts)) < SINGLE_CLASSES, np.arange(len(counts)), shared)
        mass = np.bincount(self.cls, counts + 0.5, CLASSES)
        self.share = (np.log(counts + 0.5) - np.log(mass[self.cls])).astype(np.float32)
        self.prior = np.maximum(mass, 1e-9) / mass.sum()
        self.input = np.empty(len(counts), np.int16)
        rank = np.arange(len(counts))
        #: frequent ids by number, the others OWN_INPUTS
        self.rank = np.empty(len(counts), np.int64)
        self.rank[order] = np.minimum(rank, OWN_INPUTS)
        self.frequent = order[:OWN_INPUTS]
        self.input[order] = np.where(rank < OWN_INPUTS, rank, OWN_INPUTS + (order * 2654435761 >> 7) % (INPUTS - OWN_INPUTS))

    def sequences(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids with an end before each text and after the last, start of each text): the id after position i is at i + 1."""
        ends = np.cumsum(sizes)
        flat = np.insert(ids.astype(np.int64), ends - sizes, self.end)
        return np.r_[flat, self.end], ends - sizes + np.arange(len(sizes))

    def windows(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(halves: ids in rows of half a window, the first row void, each text
        from a row of its own on; number of rows of each text; places of all
        next ids in the rows after the first; the next ids). Rows i and i + 1 are a window."""
        y, starts = self.sequences(ids, sizes)
        half = WINDOW // 2
        n = (sizes + half) // half
        place = np.arange(len(y) - 1) + np.repeat((np.cumsum(n) - n) * half - starts, sizes + 1)
        halves = np.full((int(n.sum()) + 1, half), self.end, np.int32)
        halves[1:].reshape(-1)[place] = y[:-1]
        return halves, n, place, y[1:]


def _first_rows(n: np.ndarray) -> np.ndarray:
    """Which of the rows of all texts is its text's first, by their numbers of rows."""
    first = np.zeros(int(n.sum()), bool)
    first[np.cumsum(n) - n] = True
    return first


_CLASS_CELLS = INPUTS * CLASSES
_CELLS = _CLASS_CELLS + INPUTS * (OWN_INPUTS + 1)


def pair_cells(b: Block, layout: Layout) -> np.ndarray:
    """The cells of (input, next class) and of (input, next frequent id) at each place of the block's training documents."""
    train = ~b.held
    if not train.any():
        return np.empty(0, np.int64)
    ids, sizes = b.ids(train)
    y, _ = layout.sequences(ids, sizes[train])
    x = layout.input[y[:-1]].astype(np.int64)
    return np.r_[x * CLASSES + layout.cls[y[1:]], _CLASS_CELLS + x * (OWN_INPUTS + 1) + layout.rank[y[1:]]]


class Shares:
    """Smoothed log shares from counts of the cells of :func:`pair_cells`."""

    def __init__(self, layout: Layout, cells: np.ndarray):
        by_class = cells[:_CLASS_CELLS].reshape(INPUTS, CLASSES)
        by_id = cells[_CLASS_CELLS:].reshape(INPUTS, OWN_INPUTS + 1)[:, :OWN_INPUTS]
        self.logits = np.log((by_class + SMOOTH * layout.prior) / (by_class.sum(1, keepdims=True) + SMOOTH)).astype(np.float32)
        cls = layout.cls[layout.frequent]
        weight = np.zeros((INPUTS, CLASSES))
        for c in range(CLASSES):
            weight[:, c] = by_id[:, cls == c].sum(1) + PAIR_SMOOTH
        own = PAIR_SMOOTH * np.exp(layout.share[layout.frequent])
        self.frequent = np.zeros((INPUTS, OWN_INPUTS), np.float32)
        for i in range(INPUTS):
            self.frequent[i] = np.log((by_id[i] + own) / weight[i, cls])
        self.rest = (math.log(PAIR_SMOOTH) - np.log(weight)).astype(np.float32)


_SHAPES = {"E": (INPUTS, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, CLASSES), "r": (WINDOW,)}


def fresh(seed: int = 0) -> dict[str, np.ndarray]:
    """First parameters; the output projection is zero, so the model starts as the shares alone."""
    rng = np.random.default_rng(seed)
    p = {n: rng.normal(0, 0.5 if n == "E" else WIDTH ** -0.5, s).astype(np.float32) for n, s in _SHAPES.items()}
    p["o"][:] = 0
    p["r"] = -0.1 * np.arange(WINDOW, dtype=np.float32)
    return p


def _by_input(x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the inputs in ``x``, sum of the ``rows`` of each)."""
    order = np.argsort(x.reshape(-1).astype(np.int16), kind="stable")
    x = x.reshape(-1)[order]
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return x[first], np.add.reduceat(rows.reshape(-1, rows.shape[-1]).take(order, axis=0), first, axis=0)


#: rows of one product in :func:`_product`
SLICE = 256


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of many rows with few columns, as a sum of products of SLICE
    rows: a single one takes more than twice the time."""
    n = len(a) // SLICE * SLICE
    out = a[n:].T @ b[n:]
    if n:
        out += np.matmul(a[:n].reshape(-1, SLICE, a.shape[1]).transpose(0, 2, 1), b[:n].reshape(-1, SLICE, b.shape[1])).sum(0)
    return out


#: logits within it need no shift before exp: products of two weights stay normal float32 numbers
SAFE = 40.0


def _weights(s: np.ndarray, r: np.ndarray, mask: np.ndarray | None, back: np.ndarray) -> np.ndarray:
    """exp of logits ``s`` (overwritten) plus the part ``r`` of their distance
    ``back``, 0 for later ids and those not in ``mask`` (None: all exist).
    Against the largest of each place where exp could leave its range."""
    seen = back >= 0
    r = np.where(seen, r[np.maximum(back, 0)], 0).astype(s.dtype)
    if s.size == 0 or max(np.abs(r).max(), s.max(), -s.min()) < SAFE:
        np.exp(s, out=s)
        s *= np.where(seen, np.exp(r), 0).astype(s.dtype)
        if mask is not None:
            part = np.flatnonzero(~mask.all(1))  # few rows have ids that don't exist
            s[part] *= mask[part][:, None, :]
        return s
    s = np.where(seen if mask is None else seen & mask[:, None, :], s + r, s.dtype.type(-1e9))
    s -= s.max(2, keepdims=True)
    return np.exp(s, out=s)


def _shifted(z: np.ndarray) -> np.ndarray:
    """Rows of class logits ``z``, less their largest where exp could leave its range."""
    if z.size and not (z.max() < 2 * SAFE and z.min() > -2 * SAFE):
        z -= z.max(1, keepdims=True)
    return z


def gradients(p: dict, ctx: np.ndarray, mask: np.ndarray, logits: np.ndarray, goal: np.ndarray,
              live: np.ndarray | None = None) -> tuple[dict, float]:
    """Gradients of the mean cross entropy, and its value. ``ctx``: inputs of
    WINDOW ids (latest last), ``mask``: which of them exist, ``goal``: the next
    class of each of the last ids (or of the last one alone), ``logits``: the
    shares' part there, ``live``: which of them are targets.

    Row sums are products with ones, and logits are shifted only if they are
    large: reductions over short rows take most of the time otherwise. Keys and
    values are transposed by a copy, which products of small matrices need to
    be quick."""
    n, kind, ctx = len(ctx), p["E"].dtype, ctx.astype(np.intp)
    m = goal.size // n
    back = np.arange(WINDOW - m, WINDOW)[:, None] - np.arange(WINDOW)
    each, keys = np.ones(WIDTH, kind), np.concatenate([p["k"], p["v"]], 1)
    root = kind.type(WIDTH ** -0.5)
    own = p["E"].take(ctx, axis=0)
    last = own[:, WINDOW - m:].reshape(-1, WIDTH)
    kv = (own.reshape(-1, WIDTH) @ keys).reshape(n, WINDOW, 2 * WIDTH)
    key, val = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
    turned = np.ascontiguousarray(kv.transpose(0, 2, 1))
    q = (last @ (p["q"] * root)).reshape(n, m, WIDTH)
    a = _weights(np.matmul(q, turned[:, :WIDTH]), p["r"], None if mask.all() else mask, back)
    a *= (1 / (a.reshape(-1, WINDOW) @ np.ones(WINDOW, kind))).reshape(n, m, 1)
    h = np.matmul(a, val).reshape(-1, WIDTH)
    z = h @ p["o"]
    z += logits.reshape(-1, CLASSES)
    z = _shifted(z)
    goal, at = goal.reshape(-1), np.arange(n * m)
    told = z[at, goal]
    e = np.exp(z, out=z)
    total = e @ np.ones(CLASSES, kind)
    weight = np.ones(n * m, kind) if live is None else live.reshape(-1).astype(kind)
    weight /= max(weight.sum(), 1)
    loss = float(((np.log(total) - told) * weight).sum())
    e *= (weight / total)[:, None]
    e[at, goal] -= weight
    dh = e @ p["o"].T
    # the mean of the weights' gradients is that of h along itself
    ds = np.matmul(dh.reshape(n, m, WIDTH), turned[:, WIDTH:])
    ds -= ((dh * h) @ each).reshape(n, m, 1)
    ds *= a
    dkv = np.empty_like(kv)
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
    np.matmul(a.transpose(0, 2, 1), dh.reshape(n, m, WIDTH), out=dkv[:, :, WIDTH:])
    dq = np.matmul(ds, key).reshape(-1, WIDTH)
    dkv = dkv.reshape(-1, 2 * WIDTH)
    down = (dkv @ keys.T).reshape(n, WINDOW, WIDTH)
    down[:, WINDOW - m:] += (dq @ (p["q"] * root).T).reshape(n, m, WIDTH)
    at, sums = _by_input(ctx, down)
    dE = np.zeros_like(p["E"])
    dE[at] = sums
    by_key = _product(own.reshape(-1, WIDTH), dkv)
    dr = np.bincount(np.maximum(back, 0).reshape(-1), (np.ones(n, kind) @ ds.reshape(n, -1)), WINDOW).astype(p["r"].dtype)
    return {"E": dE, "q": _product(last, dq) * root, "k": by_key[:, :WIDTH], "v": by_key[:, WIDTH:], "o": _product(h, e), "r": dr}, loss


class Adam:
    """Steps on parameters ``p``, whose arrays become parts of one array."""

    def __init__(self, p: dict):
        self.names, self.t = list(p), 0
        self.x = np.concatenate([p[n].reshape(-1) for n in p])
        self.m, self.s, self.d = (np.zeros_like(self.x) for _ in range(3))
        at = 0
        for n, x in p.items():
            p[n] = self.x[at:at + x.size].reshape(x.shape)
            at += x.size

    def step(self, g: dict) -> None:
        self.t += 1
        rate = RATE * math.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        m, s, d, g = self.m, self.s, self.d, np.concatenate([g[n].reshape(-1) for n in self.names])
        m *= 0.9
        m += np.multiply(0.1, g, out=d)
        s *= 0.99
        np.square(g, out=d)
        d *= 0.01
        s += d
        np.sqrt(s, out=d)
        d += 1e-8
        np.divide(m, d, out=d)
        d *= rate
        self.x -= d


def training_windows(b: Block, layout: Layout, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of windows that overlap by half, which of them exist, next ids of
    the later half, which of these are targets) of the training documents of
    round ``turn`` (each document has one); each id and end is a target once."""
    train = ~b.held & (np.arange(len(b.held)) % ROUNDS == turn)
    ids, sizes = b.ids(train)
    halves, n, place, after = layout.windows(ids, sizes[train])
    half = WINDOW // 2
    mask = np.ones((len(halves) - 1, WINDOW), bool)
    mask[_first_rows(n), :half] = False
    goal, live = np.zeros((len(mask), half), np.int32), np.zeros((len(mask), half), bool)
    goal.reshape(-1)[place], live.reshape(-1)[place] = after, True
    return np.concatenate([halves[:-1], halves[1:]], 1), mask, goal, live


def train(held: DataFrame, layout: Layout, logits: np.ndarray) -> dict:
    """Parameters after all rounds (see the module's text)."""
    sc = held.sparkSession.sparkContext
    p = fresh()
    names = list(_SHAPES)
    size = sum(math.prod(_SHAPES[n]) for n in names)
    told = sc.broadcast((layout, logits))
    for turn in range(ROUNDS):
        now = sc.broadcast(p)

        def run(batches, now=now, turn=turn):
            layout, logits = told.value
            own = {n: x.copy() for n, x in now.value.items()}
            adam, weight = Adam(own), 0
            rng = np.random.default_rng(turn)
            for _, b in _each(batches):
                y, mask, goal, live = training_windows(b, layout, turn)
                x, goal = layout.input[y], layout.cls[goal]
                order = rng.permutation(len(x))
                for i in range(0, len(x), BATCH):
                    pick = order[i:i + BATCH]
                    now = x.take(pick, axis=0)
                    adam.step(gradients(own, now, mask.take(pick, axis=0), logits.take(now[:, WINDOW // 2:], axis=0),
                                        goal.take(pick, axis=0), live.take(pick, axis=0))[0])
                weight += int(live.sum())
            flat = np.concatenate([*(own[n].reshape(-1) for n in names), [1.0]]).astype(np.float64) * weight
            yield _chunks(np.arange(size + 1), flat, 1024)

        flat = _added(held.mapInArrow(run, _SUMS), size + 1, 1024)
        if not flat[-1]:
            continue
        flat, at = flat[:-1] / flat[-1], 0
        for n in names:
            k = math.prod(_SHAPES[n])
            p[n] = flat[at:at + k].reshape(_SHAPES[n]).astype(np.float32)
            at += k
    return p


class Scorer:
    """The trained model; scores ids in windows."""

    def __init__(self, layout: Layout, shares: Shares, p: dict):
        self.layout, self.logits, self.shares, self.half = layout, shares.logits, shares, WINDOW // 2
        self.q = (p["E"] @ p["q"] / WIDTH ** 0.5).astype(np.float32)
        self.k = (p["E"] @ p["k"]).astype(np.float32)
        # a column of ones makes the same product sum the weights
        self.v = np.concatenate([p["E"] @ p["v"], np.ones((INPUTS, 1))], 1).astype(np.float32)
        self.o = p["o"]
        # weight of key j for query i of a window: causal, and at most WINDOW back
        self.back = np.arange(self.half)[:, None] + self.half - np.arange(WINDOW)
        self.r = p["r"]
        self.near = np.where(self.back >= 0, np.exp(p["r"][np.clip(self.back, 0, WINDOW - 1)]), 0).astype(np.float32)

    def score(self, ids: np.ndarray, sizes: np.ndarray, at_once: int = 256) -> np.ndarray:
        """Natural log probability of each text, its end included."""
        halves, n, place, after = self.layout.windows(ids, sizes)
        x, first, half = self.layout.input[halves], _first_rows(n), self.half
        before = x[1:].reshape(-1)[place]
        cls, rank = self.layout.cls[after], self.layout.rank[after]
        # the share of each id within its class, after the id before it
        out = np.where(rank < OWN_INPUTS, self.shares.frequent[before, np.minimum(rank, OWN_INPUTS - 1)],
                       self.layout.share[after] + self.shares.rest[before, cls])
        goal = np.zeros((len(first), half), np.int16)
        goal.reshape(-1)[place] = cls
        told, ones = np.empty(goal.size), np.ones(CLASSES, np.float32)
        for i in range(0, len(first), at_once):
            rows = slice(i, i + at_once)
            now = x[i:i + at_once + 1].astype(np.intp)
            m, last = len(now) - 1, now[1:]
            both = np.concatenate([now[:-1], last], 1)
            mask = None
            if first[rows].any():
                mask = np.ones((m, WINDOW), bool)
                mask[first[rows], :half] = False
            # a transposed copy makes products of small matrices quick
            keys = np.ascontiguousarray(self.k.take(both, axis=0).transpose(0, 2, 1))
            a = _weights(np.matmul(self.q.take(last, axis=0), keys), self.r, mask, self.back)
            h = np.matmul(a, self.v.take(both, axis=0))
            h = h.reshape(-1, WIDTH + 1)
            h = h[:, :WIDTH] / h[:, WIDTH:]
            z = self.logits.take(last.reshape(-1), axis=0)
            z += h @ self.o
            z = _shifted(z)
            own = z[np.arange(len(z)), goal[rows].reshape(-1)]
            np.exp(z, out=z)
            told[i * half:(i + m) * half] = own - np.log(z @ ones)
        return np.bincount(np.repeat(np.arange(len(sizes)), sizes + 1), out + told[place], len(sizes))


def fit(held: DataFrame, n_ids: int) -> Scorer:
    """Count, lay out and train on the training documents of the table of blocks."""
    def used(b):
        words = np.bincount(b.codes[(~b.held)[b.owner]], minlength=len(b.hashes))
        return np.r_[b.pieces, n_ids].astype(np.int64), np.r_[np.repeat(words, b.counts), (~b.held).sum()].astype(float)

    layout = Layout(_summed(held, used, n_ids + 1))
    told = held.sparkSession.sparkContext.broadcast(layout)
    shares = Shares(layout, _summed(held, lambda b: pair_cells(b, told.value), _CELLS))
    return Scorer(layout, shares, train(held, layout, shares.logits))


def scores(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids) of every row; scores are log10."""
    from tokenizers import Tokenizer
    n_ids = Tokenizer.from_file(path).get_vocab_size()
    held = blocks(docs, path, id_col, text_col)
    counts = materialise(word_counts(held), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, floor = total["n"], total["n"] + 0.5 * (total["v"] + 1)
    sc = docs.sparkSession.sparkContext
    # words of at least one in HEAD of all tokens: at most HEAD words
    head = counts.where(F.col("n") * HEAD >= tokens).toArrow().to_pydict() if tokens else {"hash": [], "n": []}
    order = np.argsort(head["hash"], kind="stable")
    common = sc.broadcast((np.array(head["hash"], np.int64)[order], np.array(head["n"], np.int64)[order]))
    ends = counts.where(F.col("hash") == END_WORD).first()
    end = (ends["n"] if ends else 0)
    model = sc.broadcast(fit(held, n_ids))

    def run(batches):
        known, seen = common.value
        for block, b in _each(batches):
            found = np.minimum(np.searchsorted(known, b.hashes), max(len(known) - 1, 0))
            count = np.where(known[found] == b.hashes, seen[found], 0) if len(known) else np.zeros(len(b.hashes), np.int64)
            worth = np.log10((count + 0.5) / floor)
            isin = count[b.codes] > 0
            m = len(b.sizes)
            base = np.bincount(b.owner, np.where(isin, worth[b.codes], 0), m) + math.log10((end + 0.5) / floor)
            have = np.bincount(b.owner, isin, m).astype(np.int64) + (end > 0)
            # the other words, each once per document
            pair, times = np.unique(b.owner[~isin] * len(b.hashes) + b.codes[~isin], return_counts=True)
            cut = np.r_[0, np.cumsum(np.bincount(pair // max(len(b.hashes), 1), minlength=m))]
            rare = b.hashes[pair % max(len(b.hashes), 1)]
            ids, n = b.ids()
            score = model.value.score(ids, n) / math.log(10)
            cut = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, block), pa.int64()), pa.array(np.arange(m), pa.int32()), pa.array(b.names, pa.string()),
                pa.array(b.held), pa.array(b.sizes + 1, pa.int64()), pa.array(n + 1, pa.int64()), pa.array(have, pa.int64()),
                pa.array(base), pa.array(score), pa.ListArray.from_arrays(cut, pa.array(rare, pa.int64())),
                pa.ListArray.from_arrays(cut, pa.array(times, pa.int64()))],
                ["block", "at", "name", "held_out", "n_tokens", "n_ids", "head_known", "head_base", "score", "rare", "times"])

    scored = materialise(held.mapInArrow(
        run, "block bigint, at int, name string, held_out boolean, n_tokens bigint, n_ids bigint, head_known bigint, "
             "head_base double, score double, rare array<bigint>, times array<bigint>"), "scored")
    rare = scored.select("block", "at", F.inline(F.arrays_zip(F.col("rare").alias("hash"), F.col("times").alias("times"))))
    less = counts.where(F.col("n") * HEAD < tokens)
    n = F.coalesce("n", F.lit(0))
    tail = rare.join(less, "hash", "left").groupBy("block", "at").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10((n + 0.5) / F.lit(float(floor)))).alias("tail_base"))
    return scored.join(tail, ["block", "at"], "left").select(
        F.col("name").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"), "score", "n_ids")


def op5_lm(spark, sf_dir: str) -> DataFrame:
    """All documents scored by the attention model, and by the unigram base."""
    import public_tokenizers
    return scores(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
