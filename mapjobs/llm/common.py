"""Small helpers shared by the operators: Arrow batches as byte strings, stable hashing of ids."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F


def crc_mod(column: str, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``most`` bytes of text, one row at least.

    It bounds a task's memory by ``most`` and the longest text, whatever the size of Arrow batches.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(name)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)


_held: list = []


def held(key: object, make: Callable[[], object]) -> object:
    """What ``make`` builds, kept by the worker process over its tasks while ``key`` stays the same.

    A worker keeps one thing only, whichever operator asks: what an earlier operator left is given up first, so
    that a chain of operators in one session never holds the caches of two.
    """
    if not _held or _held[0] != key:
        release()
        _held[:] = [key, make()]
    return _held[1]


def release() -> None:
    """Gives up what ``held`` keeps."""
    if _held:
        _held.clear()
        pa.default_memory_pool().release_unused()


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


import pyarrow.compute  # noqa: E402,F401  (pa.compute above)
