"""What a Python worker process keeps between tasks: one operator's object at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

from millrace.llm import words

_held: dict[str, Any] = {}
_set_up = False


def _give_back() -> None:
    """Have the C library hand memory back: arrays over 1 MB as soon as they are freed (once set), the rest now."""
    global _set_up
    try:
        c = ctypes.CDLL(None)
        if not _set_up:
            c.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD; left alone, it grows with what has been freed
            _set_up = True
        c.malloc_trim(0)
    except (AttributeError, OSError):
        pass  # only where the C library has them
    pa.default_memory_pool().release_unused()


def only(name: str, make: Callable[[], Any] | None = None) -> Any:
    """The object of this name, made once in this process. When another name is asked for, what was held goes first.

    Workers serve one operator after another; without this the memos of all of them would add up.
    """
    if name not in _held:
        _held.clear()
        words.forget()
        gc.collect()
        _give_back()
        _held[name] = make() if make else None
    return _held[name]
