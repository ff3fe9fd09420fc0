"""What a worker process keeps between its tasks: one model at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, build: Callable[[], Any]) -> Any:
    """The model of ``key``. Another one that the worker still holds, from a task of another
    operator, is given up and its memory returned before the new one is built."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            return_memory()
        _kept[key] = build()
    return _kept[key]


def return_memory() -> None:
    """Give freed memory back to the system, as far as the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
