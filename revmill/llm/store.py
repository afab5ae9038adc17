"""Binary arrays in the shared folder, memory-mapped by workers.

A folder that every machine mounts (file:) is mapped in place. Files of another store are
fetched to the worker's own temporary folder first, once for each worker process; nothing
else ever reads that copy.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np

_open: dict[tuple[str, str], np.ndarray] = {}


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def put(folder: str, name: str, array: np.ndarray) -> str:
    """Writes an array under a name that no other attempt uses, and returns its address. A
    repeated task leaves a second file that nothing refers to."""
    name = f"{name}-{uuid.uuid4().hex[:12]}.bin"
    path = _local(folder)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        array.tofile(os.path.join(path, name))
    else:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}") as out:
            out.write(memoryview(array).cast("B"))
    return f"{folder.rstrip('/')}/{name}"


def mapped(uri: str, dtype: str) -> np.ndarray:
    """The array behind an address, mapped read-only and kept open by the worker."""
    key = (uri, dtype)
    if key not in _open:
        path = _local(uri)
        if path is None:
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(uri)
            path = os.path.join(tempfile.gettempdir(), os.path.basename(uri))
            if not os.path.exists(path):
                part = f"{path}.{os.getpid()}"
                with store.open_input_stream(base) as source, open(part, "wb") as out:
                    while block := source.read(1 << 22):
                        out.write(block)
                os.replace(part, path)
        _open[key] = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    return _open[key]
