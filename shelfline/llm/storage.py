"""Files in the shared folder that tasks open themselves: archives and lookup tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is a shared mount."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def read_parquet(path: str, columns: list[str] | None = None, filters=None) -> pa.Table:
    """A Parquet folder, read by a task."""
    system, inner = open_folder(path)
    return pq.read_table(inner, columns=columns, filters=filters, filesystem=system)
