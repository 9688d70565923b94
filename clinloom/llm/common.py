"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.session import ship_package

#: Rows, and bytes of them, handled at once inside a task, so that a batch of very long texts stays small.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 20


class Memory(dict):
    """From a string to what ``make`` gives for it, a few numbers; fills itself. It holds ``most`` keys of up to 64
    characters (some 200 bytes each with their values), then starts anew. Made in a task, it goes with the task."""

    def __init__(self, make: Callable, most: int = 150_000):
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def rows_in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from _halves(batch.slice(at, rows))


def _halves(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if part.num_rows > 1 and part.nbytes > SLICE_BYTES:
        half = part.num_rows // 2
        yield from _halves(part.slice(0, half))
        yield from _halves(part.slice(half))
    else:
        yield part


def give_back() -> None:
    """Returns the memory that a task has freed to the system; a reused worker would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def add_columns(
    df: DataFrame, new: str, make: Callable[[], Callable[[pa.RecordBatch], list]]
) -> DataFrame:
    """``df`` with the columns of the DDL ``new``, computed slice by slice from Arrow batches.
    ``make`` runs once in each task and returns the function of a slice to the new columns' arrays.
    A new column replaces one of the same name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = df.sparkSession
    ship_package(spark)
    added = spark.createDataFrame([], new).schema
    # positions stand for names inside, so that clashing or repeated names do no harm
    keep = [i for i, f in enumerate(df.schema.fields) if f.name not in added.fieldNames()]
    schema = StructType([df.schema.fields[i] for i in keep] + added.fields)
    types = [f.type for f in to_arrow_schema(added)]
    names = schema.fieldNames()

    def run(batches):
        work = make()
        for part in rows_in_slices(batches):
            out = [pa.array(x, type=t) if not isinstance(x, (pa.Array, pa.ChunkedArray)) else x for x, t in zip(work(part), types, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(i) for i in keep] + out, names=names)
        del work
        give_back()

    return df.mapInArrow(run, schema)


def crc32_mod(doc_id, n: int):
    """crc32 of the id's decimal text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)
