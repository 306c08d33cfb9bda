"""What a Python worker holds during a task, and how it gives it back when the task ends."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa

HELD = "_siftstone_held"


def kept(key: str, make: Callable[[], Any]) -> Any:
    """One value of this key until release()."""
    held = sys.modules.setdefault(HELD, types.ModuleType(HELD))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)


def release() -> None:
    """Drops what is kept and hands free memory back to the system: a reused worker would else hold a task's peak beside the next task's."""
    sys.modules.pop(HELD, None)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def released(rows: Iterable[Any]) -> Iterator[Any]:
    """rows, and then release()."""
    yield from rows
    release()
