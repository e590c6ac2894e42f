"""Arrays in files of the shared folder, written by tasks and memory-mapped by others."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)  # file://, or that of a store; a plain path is a local one


def write(folder: str, name: str, arrays: list[np.ndarray]) -> str:
    """Write the arrays one after the other to a new file; its name is new too, so a repeated task disturbs nobody."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{file}") as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return file


def read(folder: str, file: str, kinds: list[tuple[str, int]]) -> list[np.ndarray]:
    """The arrays of a file as (type, length) tell, memory-mapped.  A file of a remote store is copied first; the copy
    has no name and goes with the process."""
    system, path = _place(folder)
    if isinstance(system, fs.LocalFileSystem):
        place, copied = f"{path}/{file}", False
    else:
        with tempfile.NamedTemporaryFile(delete=False) as copy, system.open_input_stream(f"{path}/{file}") as source:
            while chunk := source.read(8 << 20):
                copy.write(chunk)
        place, copied = copy.name, True
    data = np.memmap(place, np.uint8, "r") if os.path.getsize(place) else np.zeros(0, np.uint8)
    if copied:
        os.unlink(place)
    out, at = [], 0
    for kind, n in kinds:
        size = np.dtype(kind).itemsize * n
        out.append(data[at : at + size].view(kind))
        at += size
    return out
