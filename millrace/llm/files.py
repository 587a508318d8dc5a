"""Files below the shared folder, by URI: any store that pyarrow reaches, so executors and the driver see the same ones.

A task writes under a name of its own and returns it; only names that a committed table holds are read, so a retried or
speculative task leaves no second copy in any result.
"""

from __future__ import annotations

import uuid


def open_store(uri: str):
    """(file system, path) of a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def create(folder: str, suffix: str):
    """A new file in the folder: (its URI, an output stream)."""
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", store.open_output_stream(f"{path}/{name}", compression=None)


def read(uri: str):
    store, path = open_store(uri)
    return store.open_input_stream(path, compression=None)
