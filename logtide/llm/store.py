"""Arrays as raw files in the shared folder, written once and memory-mapped by workers.

A file appears under its name only when it is complete, so a task that is run twice, or
again after its executor was lost, leaves one whole file. Folders of a mounted file system
are mapped in place; other stores are copied to the worker's own temporary folder first.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def _local(folder: str) -> str | None:
    url = urlparse(folder)
    return unquote(url.path) if url.scheme == "file" else folder if not url.scheme else None


def put(folder: str, name: str, data: bytes) -> None:
    """Write ``data`` as file ``name`` of ``folder``, whole or not at all."""
    local = _local(folder)
    if local is not None:
        os.makedirs(local, exist_ok=True)
        part = f"{local}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            out.write(data)
        os.replace(part, f"{local}/{name}")
        return
    from pyarrow.fs import FileSystem

    store, root = FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{root}/{name}")


def path_of(folder: str, name: str) -> str:
    """A local path of the file: in place, or a copy made once per worker folder."""
    local = _local(folder)
    if local is not None:
        return f"{local}/{name}"
    copy = f"{tempfile.gettempdir()}/{hashlib.sha256(folder.encode()).hexdigest()[:16]}-{name}"
    if not os.path.exists(copy):
        from pyarrow.fs import FileSystem, LocalFileSystem, copy_files

        part = f"{copy}-{uuid.uuid4().hex}"
        store, root = FileSystem.from_uri(folder)
        copy_files(f"{root}/{name}", part, source_filesystem=store, destination_filesystem=LocalFileSystem())
        os.replace(part, copy)
    return copy


def read(folder: str, name: str) -> bytes:
    with open(path_of(folder, name), "rb") as f:
        return f.read()


def mapped(folder: str, name: str, dtype: str, length: int) -> np.ndarray:
    if not length:
        return np.empty(0, dtype)
    return np.memmap(path_of(folder, name), dtype, "r", shape=(length,))
