"""The shared store as tasks open it: any file system that Arrow knows."""

from __future__ import annotations

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path
