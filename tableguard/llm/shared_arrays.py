"""Sorted arrays in the cluster's shared folder: written by tasks, memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
from pyarrow import fs

_open: dict[str, np.ndarray] = {}


def _local(path: str) -> str | None:
    url = urlparse(path)
    return url.path if url.scheme in ("", "file") else None


def save(folder: str, x: np.ndarray) -> str:
    """Write an array under a new name; a task that runs again writes another file, and only the name in
    the successful task's result is ever read."""
    path = f"{folder}/{uuid.uuid4().hex}.bin"
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as f:
            f.write(x.tobytes())
    else:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_output_stream(name) as f:
            f.write(x.tobytes())
    return path


def load(path: str, dtype) -> np.ndarray:
    """Map the array into memory; from a store without local paths by way of the worker's own folder."""
    if path not in _open:
        local = _local(path)
        if local is None:
            store, name = fs.FileSystem.from_uri(path)
            with tempfile.NamedTemporaryFile(delete=False) as out, store.open_input_stream(name) as f:
                while block := f.read(1 << 24):
                    out.write(block)
                local = out.name
        _open[path] = np.memmap(local, dtype, "r") if os.path.getsize(local) else np.zeros(0, dtype)
    return _open[path]
