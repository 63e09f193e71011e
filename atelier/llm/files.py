"""Files that tasks write to and read from the shared folder, by its URI.

A task's file has a new name each time it runs, and only the rows that a
successful task returns name files, so what a lost or repeated task leaves
behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes file:/x for file:///x.
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def open_new(uri: str):
    system, path = _place(uri)
    return system.open_output_stream(path, compression=None)


def open_file(uri: str):
    """A readable file with seek()."""
    system, path = _place(uri)
    return system.open_input_file(path)
