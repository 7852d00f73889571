"""What the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.session import ship

#: Bytes of text that one block of rows holds at most, unless one text alone is longer.
BLOCK_BYTES = 4 << 20
#: A-Z to a-z, other bytes as they are.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of bounded bytes of the batches, each with its texts as UTF-8 (null: empty)."""
    for batch in batches:
        at, rows = 0, batch.num_rows
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = [0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()]
        while at < rows:
            end, held = at, 0
            while end < rows and (end == at or held + sizes[end] <= BLOCK_BYTES):
                held += sizes[end]
                end += 1
            part = batch.slice(at, end - at)
            yield part, [b"" if x is None else x for x in column.slice(at, end - at).to_pylist()]
            at = end


def map_arrow(df: DataFrame, f: Callable, schema: str, table: Callable[[], dict] | None = None) -> DataFrame:
    """mapInArrow with this package on the executors; table: the worker-wide table that f uses, all others are emptied."""
    ship(df.sparkSession)

    def run(batches):
        sole(table() if table else {})
        try:
            yield from f(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def give_back() -> None:
    """Returns memory that a task freed to the system: workers outlive their tasks and share an executor with others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of a step's own, none of which df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n in taken:
            n += "_"
        taken.add(n)
        out.append(n)
    return out


_tables: list[dict] = []


def sole(table: dict) -> None:
    """Empties the worker-wide tables of all other operators: a worker serves many, and holds one's tables at a time."""
    _tables[:] = [t for t in _tables if t]
    if not any(t is table for t in _tables):
        _tables.append(table)
    for t in _tables:
        if t is not table and t:
            t.clear()
            gc.collect()

