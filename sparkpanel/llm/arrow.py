"""Arrow batches inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa


def release() -> None:
    """Give freed memory back to the machine: a worker that has done its task may idle for long."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same task, which gives its memory back at the end."""
    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        release()

    return run


def sized(row: tuple) -> int:
    return 64 + sum(len(x) for x in row if isinstance(x, (str, bytes)))


def batched(rows: Iterable[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``most`` bytes."""
    held, size = [], 0

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += sized(row)
        if size >= most:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def small(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``column`` holds about ``most`` bytes each; a longer value is alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield batch.slice(first)
