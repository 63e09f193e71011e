"""Memory of the Python workers, which Spark uses again for later tasks and stages.

What a task freed stays with its worker's allocators, and what a worker keeps
between tasks stays while other steps run. A task that is ``lean`` forgets what
other steps kept when it begins, and gives back what it freed when it ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable

import pyarrow as pa

#: Groups of fewer bytes leave little behind.
LARGE_GROUP = 1 << 20
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """What this worker made for the key; only the last key's value is kept."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    _KEPT.clear()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable, keeps: bool = False) -> Callable:
    """A function of batches; with ``keeps`` it uses what ``kept`` made in earlier tasks."""

    def task(batches):
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of one group."""

    def group(table: pa.Table) -> pa.Table:
        forget()
        out = run(table)
        if table.nbytes > LARGE_GROUP:
            give_back()
        return out

    return group
