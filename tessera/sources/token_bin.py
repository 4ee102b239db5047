"""Fixed-width binary token files (A3): flat little-endian uint16 tokens,
``ctx_len`` per row.

Both directions are a Python data source (``tokenbin``). Paths may lie in any
file system that Arrow opens (local or mounted folders, ``file:``, ``hdfs:``,
``s3:`` ...).

Reading: input partitions are record-aligned row ranges of the files, so a
large file is split across many tasks and no task reads more than
``rows_per_split`` rows. The driver only lists files and checks that every
size is a whole number of rows (a ragged tail would otherwise surface as a
mid-task read error). Files are read in order of their names, which for
written files is the order of the writer's partitions. A range of rows
(``start``, ``end``) is an option of the read: only its bytes are read. It isn't
taken from filters on ``idx``, as Spark 4.1 keeps a Python source's pushed
filters for later queries of the same DataFrame, which then lack rows.

Writing: each task attempt writes a file under a temporary name and reports
it; Spark's commit of the job renames the reported files (and, in overwrite
mode, removes the earlier ones), its abort removes what attempts left.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tessera.operators.positions import in_pieces
from tessera.sources.store import open_store

TOKEN_DTYPE = np.dtype("<u2")
SCHEMA = "idx bigint, input_ids array<int>"


def _files(path: str) -> list[tuple[str, int]]:
    """(path in its store, size) of a token file, or of a folder's ``.bin`` parts in order."""
    store, at = open_store(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no token file at {path}")
    if info.type == fs.FileType.File:
        return [(at, info.size)]
    found = store.get_file_info(fs.FileSelector(at))
    return sorted((i.path, i.size) for i in found if i.type == fs.FileType.File and i.base_name.endswith(".bin")
                  and not i.base_name.startswith(("_", ".")))


class _Split(InputPartition):
    """Rows ``[start, start + rows)`` of one file; ``index`` is the global
    position of the first of them."""

    def __init__(self, file: str, start: int, rows: int, index: int):
        super().__init__(None)
        self.file, self.start, self.rows, self.index = file, start, rows, index


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.ctx = int(options["ctx_len"])
        ends = [int(options[k]) for k in ("max_examples", "end") if options.get(k)]
        self.low, self.high = int(options.get("start") or 0), min(ends, default=None)
        self.rows_per_split = int(options.get("rows_per_split", 65536))

    def partitions(self):
        rec = self.ctx * TOKEN_DTYPE.itemsize
        splits, index = [], 0
        for f, size in _files(self.path):
            if size % rec:
                raise ValueError(f"{f}: size {size} is not a multiple of the row size {rec} "
                                 f"(ctx_len {self.ctx})")
            n = size // rec
            first = max(self.low - index, 0)
            last = n if self.high is None else min(n, self.high - index)
            for s in range(first, last, self.rows_per_split):
                splits.append(_Split(f, s, min(self.rows_per_split, last - s), index + s))
            index += n
            if self.high is not None and index >= self.high:
                break
        return splits or [_Split("", 0, 0, 0)]

    def read(self, part: _Split):
        if part.rows == 0:
            return
        rec = self.ctx * TOKEN_DTYPE.itemsize
        step = max(1, (1 << 20) // self.ctx)
        with open_store(self.path)[0].open_input_file(part.file) as f:
            for s in range(0, part.rows, step):
                n = min(step, part.rows - s)
                f.seek((part.start + s) * rec)
                arr = np.frombuffer(f.read(n * rec), TOKEN_DTYPE).astype(np.int32)
                ids = pa.FixedSizeListArray.from_arrays(pa.array(arr), self.ctx).cast(pa.list_(pa.int32()))
                idx = pa.array(np.arange(part.index + s, part.index + s + n, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([idx, ids], names=["idx", "input_ids"])


class _Part(WriterCommitMessage):
    """A task attempt's file, and its number of rows."""

    def __init__(self, name: str, rows: int):
        self.name, self.rows = name, rows


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.ctx, self.overwrite, self.job = options["path"], int(options["ctx_len"]), overwrite, uuid.uuid4().hex

    def write(self, batches):
        store, at = open_store(self.path)
        store.create_dir(at, recursive=True)
        task = TaskContext.get()
        name, rows = f"part-{task.partitionId():06d}-{self.job}-{task.taskAttemptId()}.bin", 0
        with store.open_output_stream(f"{at}/_tmp-{name}") as out:
            for b in batches:
                column = b.column(0)
                lengths = np.asarray(column.value_lengths().fill_null(-1))
                if (lengths != self.ctx).any():
                    raise ValueError(f"every row must hold exactly ctx_len={self.ctx} tokens")
                flat = column.flatten().to_numpy(zero_copy_only=False)
                if len(flat) and (flat.min() < 0 or flat.max() > 0xFFFF):
                    raise ValueError("token ids must fit in uint16")
                out.write(flat.astype(TOKEN_DTYPE).tobytes())
                rows += b.num_rows
        return _Part(name, rows)

    def commit(self, messages):
        store, at = open_store(self.path)
        store.create_dir(at, recursive=True)
        earlier = _files(self.path) if self.overwrite else []
        for m in messages:
            if m is not None and m.rows:
                store.move(f"{at}/_tmp-{m.name}", f"{at}/{m.name}")
        for f, _ in earlier:
            store.delete_file(f)
        self._clear(store, at)

    def abort(self, messages):
        store, at = open_store(self.path)
        self._clear(store, at)

    def _clear(self, store, at):
        """Remove what this job's attempts left."""
        if store.get_file_info(at).type == fs.FileType.Directory:
            for i in store.get_file_info(fs.FileSelector(at)):
                if i.base_name.startswith("_tmp-") and self.job in i.base_name:
                    store.delete_file(i.path)


class TokenBinDataSource(DataSource):
    """``spark.read.format("tokenbin").option("ctx_len", n).load(path)``."""

    @classmethod
    def name(cls):
        return "tokenbin"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenBinDataSource)


def read_token_bin(spark: SparkSession, path: str, ctx_len: int, max_examples: int | None = None,
                   rows_per_split: int = 65536, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``(idx, input_ids)`` of a token file or folder of ``.bin`` parts (A3),
    from row ``start`` to before row ``end`` and within the first ``max_examples``."""
    register(spark)
    r = spark.read.format("tokenbin").option("ctx_len", ctx_len).option("rows_per_split", rows_per_split)
    for name, value in (("max_examples", max_examples), ("start", start), ("end", end)):
        if value is not None:
            r = r.option(name, value)
    return r.load(path)


def count_token_rows(path: str, ctx_len: int) -> int:
    """Rows of a token file or folder, from the files' sizes."""
    return sum(size // (ctx_len * TOKEN_DTYPE.itemsize) for _, size in _files(path))


def read_token_shard(spark: SparkSession, path: str, ctx_len: int, num_shards: int, shard_id: int, skip: int = 0,
                     rows_per_split: int = 65536) -> DataFrame:
    """Rows ``(idx, input_ids)`` of one contiguous shard (D9), without its first
    ``skip`` rows (D10). The first ``rows mod num_shards`` shards hold one row
    more. Only the shard's byte ranges are read."""
    if not 0 <= shard_id < num_shards or skip < 0:
        raise ValueError(f"no shard {shard_id} of {num_shards} without {skip} rows")
    size, more = divmod(count_token_rows(path, ctx_len), num_shards)
    start = shard_id * size + min(shard_id, more)
    end = start + size + (shard_id < more)
    return read_token_bin(spark, path, ctx_len, rows_per_split=rows_per_split, start=start + skip, end=end)


def write_token_bin(df: DataFrame, path: str, ctx_len: int, column: str = "input_ids", order=None,
                    mode: str = "error") -> None:
    """Write fixed-length id rows as uint16 part files.

    With ``order`` (columns) the rows, as read back by ``idx``, are in that
    order. ``mode``: ``error`` (the path holds token files already),
    ``overwrite`` or ``append`` (after the present rows only if the new
    parts' names sort after theirs: use one write for one ordered file).
    """
    if mode not in ("error", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    register(df.sparkSession)
    store, at = open_store(path)
    if mode == "error" and store.get_file_info(at).type != fs.FileType.NotFound and _files(path):
        raise FileExistsError(f"{path} holds token files; choose mode='overwrite' or 'append'")
    if order is not None:
        df = in_pieces(df, order)
    (df.select(F.col(column).cast("array<int>").alias("input_ids")).write.format("tokenbin")
     .option("ctx_len", int(ctx_len)).mode("append" if mode == "append" else "overwrite").save(path))
