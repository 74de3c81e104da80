"""What Python workers keep when a task has ended, and how they give it back.

Workers live longer than tasks and go on to other operators. Freed arrays stay with the
allocators, and one operator's caches serve no other, so a chain of operators would need the
sum of what each one kept.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

#: How each operator's caches are emptied, in this worker.
_CACHES: dict[str, Callable[[], None]] = {}


def holds(operator: str, empty: Callable[[], None]) -> None:
    """Say how the operator's caches are emptied once another one runs in this worker."""
    _CACHES[operator] = empty


def drop_others(operator: str | None) -> None:
    for other in [name for name in _CACHES if name != operator]:
        _CACHES.pop(other)()


def give_back() -> None:
    """Return freed memory to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batchwise(run: Callable, operator: str | None = None) -> Callable:
    """A function of batches that ends without memory of its own or of other operators."""

    @wraps(run)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(operator)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def tablewise(run: Callable, operator: str | None = None) -> Callable:
    """The same for a function of the tables of a group, with as many parameters."""
    if run.__code__.co_argcount == 1:

        @wraps(run)
        def tidy(table: pa.Table) -> pa.Table:
            drop_others(operator)
            try:
                return run(table)
            finally:
                give_back()

        return tidy

    @wraps(run)
    def tidy_pair(table: pa.Table, answers: pa.Table) -> pa.Table:
        drop_others(operator)
        try:
            return run(table, answers)
        finally:
            give_back()

    return tidy_pair
