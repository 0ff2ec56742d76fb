"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
READ_ROWS = 256
WRITE_ROWS, WRITE_CELLS = 4096, 1 << 22


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def give_back() -> None:
    """Return freed memory to the system, so that a worker that waits for its next task is small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def weight(value) -> int:
    """A rough size of one output cell in bytes."""
    if isinstance(value, (str, bytes)):
        return len(value)
    if isinstance(value, (list, tuple)):
        return 8 * len(value)
    return int(getattr(value, "nbytes", 8))


def map_rows(df: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]],
             schema: str | T.StructType) -> DataFrame:
    """Run ``work`` over the rows of each partition; rows stream through in Arrow batches.

    ``work`` gets an iterator of tuples and yields tuples in the order of ``schema``. What it yields is
    cut into batches of bounded size, so memory follows the longest row and not the partition.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kind.fieldNames()

    def run(batches):
        arrow = to_arrow_schema(kind)

        def read():
            for batch in batches:
                for start in range(0, batch.num_rows, READ_ROWS):
                    part = batch.slice(start, READ_ROWS)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def pack(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)],
                names=names)

        held, size = [], 0
        for row in work(read()):
            held.append(row)
            size += sum(map(weight, row))
            if len(held) >= WRITE_ROWS or size >= WRITE_CELLS:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return df.mapInArrow(run, kind)
