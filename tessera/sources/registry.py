"""Named-dataset scans (A1) and path-or-name resolution (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SUFFIX_FORMATS = {".parquet": "parquet", ".json": "json", ".jsonl": "json", ".csv": "csv",
                   ".orc": "orc", ".txt": "text", ".bin": "tokenbin"}


class DatasetRegistry:
    """Short key -> location. A location is a path template that may use
    ``{split}`` and ``{config}``; the format follows the suffix unless given."""

    def __init__(self, entries: dict | None = None):
        self.entries: dict[str, tuple[str, str | None]] = {}
        for k, v in (entries or {}).items():
            self.register(k, *(v if isinstance(v, tuple) else (v,)))

    def register(self, key: str, location: str, fmt: str | None = None) -> None:
        self.entries[key] = (location, fmt)

    def resolve(self, key: str, split: str = "train", config: str | None = None) -> tuple[str, str | None]:
        if key not in self.entries:
            raise ValueError(f"no dataset is registered as {key!r}")
        loc, fmt = self.entries[key]
        return loc.format(split=split, config=config or "default"), fmt

    def scan(self, spark: SparkSession, key: str, split: str = "train", config: str | None = None,
             **options) -> DataFrame:
        """Load the given split (and optional config) of a registered dataset; unknown keys raise."""
        loc, fmt = self.resolve(key, split, config)
        return scan_path(spark, loc, fmt, **options)


def detect_format(spark: SparkSession, path: str) -> str:
    """The format by a path's suffix, else by the suffix of a file under it
    (listed through Hadoop's file systems, wherever the path lies)."""
    p = path.rstrip("/")
    for suf, fmt in _SUFFIX_FORMATS.items():
        if p.endswith(suf):
            return fmt
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    for suf, fmt in _SUFFIX_FORMATS.items():
        if names.where(names["path"].endswith(suf)).limit(1).count():
            return fmt
    return "parquet"


def scan_path(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """A catalog table by name, else a saved dataset at ``path`` (A2).

    Token files need ``ctx_len``; any failure to load is re-raised.
    """
    if fmt is None and "/" not in path and spark.catalog.tableExists(path):
        return spark.table(path)
    fmt = fmt or detect_format(spark, path)
    if fmt == "tokenbin":
        from tessera.sources.token_bin import read_token_bin
        return read_token_bin(spark, path, int(options.pop("ctx_len")), options.pop("max_examples", None))
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
