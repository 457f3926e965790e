"""Files beside Spark's own readers and writers, on any store that Arrow knows: local folders, HDFS, S3."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = path.rstrip("/")
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def exists(files: fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != fs.FileType.NotFound


def put(files: fs.FileSystem, path: str, data: bytes) -> None:
    """A whole file at once: it appears under its name when all of it is there."""
    parent, name = path.rsplit("/", 1)
    files.create_dir(parent, recursive=True)
    aside = f"{parent}/_{name}-{uuid.uuid4().hex[:8]}"
    with files.open_output_stream(aside) as out:
        out.write(data)
    files.move(aside, path)


def parquet_bytes(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    pq.write_table(rows, out)
    return out.getvalue().to_pybytes()
