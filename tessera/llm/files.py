"""Binary files in shared folders, read and written from tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Spark path (``file:/x``, ``file:///x``, ``hdfs://...``, ``s3://...`` or a plain path)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class AtomicFile:
    """Output stream whose file appears under its final name only when complete.

    A retried or speculative task writes another temporary file and replaces
    the same final name with the same bytes.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = locate(folder)
        self.final = f"{base.rstrip('/')}/{name}"
        self.draft = f"{base.rstrip('/')}/.{name}.{uuid.uuid4().hex}"
        self.uri = f"{folder.rstrip('/')}/{name}"

    def __enter__(self) -> pa.NativeFile:
        self.fs.create_dir(self.draft.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.draft)
        return self.stream

    def __exit__(self, kind, *_) -> None:
        self.stream.close()
        if kind is None:
            self.fs.move(self.draft, self.final)
        else:
            self.fs.delete_file(self.draft)


def open_random(uri: str) -> pa.NativeFile:
    """The file for random access: memory mapped where it is local."""
    fs, path = locate(uri)
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
