"""A bounded table of computed values that forgets what was not asked for lately."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa


class Recent(dict):
    """Computes missing values; keeps the latest ``keep`` to twice as many.

    When ``keep`` values are in, they become the older half, and the half before goes.
    """

    def __init__(self, make: Callable, keep: int):
        super().__init__()
        self.make, self.keep, self.older = make, keep, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.keep:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def returned() -> None:
    """Gives memory that this process has freed back to the machine, where the allocators can: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not the GNU library


_held: dict = {}


def held(name: str, make: Callable):
    """What ``make`` makes, kept in a worker process from task to task, until another operator asks for its own."""
    if name not in _held:
        if _held:
            _held.clear()
            returned()
        _held[name] = make()
    return _held[name]
