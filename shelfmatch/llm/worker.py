"""What a Python worker remembers from task to task: the model of one operator at a time.

Spark uses a worker again for the tasks of later stages. Without this, the word tables of all
operators that a pipeline has run would stay in memory side by side.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_held: dict[Hashable, object] = {}


def forget() -> None:
    """Drop what is held, before work that has no model."""
    if _held:
        _held.clear()
        _give_back()


def _give_back() -> None:
    """Return the memory that earlier work has left free in this process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:  # small objects leave holes that only the C library can return
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def held(key: Hashable, make: Callable[[], object]):
    """What ``make`` made for this key, as long as no other key was asked for."""
    if key not in _held:
        _held.clear()
        _give_back()
        _held[key] = make()
    return _held[key]
