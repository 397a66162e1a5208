"""Record batches in tasks: bounded slices, text columns, clash-free column names."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 8 << 20


def give_back() -> None:
    """Return freed memory to the machine at the end of a task, as the process goes on to tasks of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps what it has
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut so that ``column`` (text, bytes or a list of ints) holds about ``most`` bytes a slice.

    A longer row stands alone.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        lengths = (pa.compute.multiply(pa.compute.list_value_length(values), 4) if pa.types.is_list(values.type)
                   else pa.compute.binary_length(values))
        lengths = pa.compute.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype("int64")
        ends = lengths.cumsum()
        first = 0
        while first < batch.num_rows:
            floor = ends[first - 1] if first else 0
            last = max(first + 1, int(ends.searchsorted(floor + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def whole_text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def with_fields(df: DataFrame, columns: list[str], **added: T.DataType) -> T.StructType:
    """The schema of the given columns of ``df`` and new ones after them; a clash is an error."""
    if clash := set(columns) & set(added):
        raise ValueError(f"columns already present: {sorted(clash)}")
    kept = [T.StructField(c, df.schema[c].dataType, True) for c in columns]
    return T.StructType(kept + [T.StructField(n, t, True) for n, t in added.items()])


def extended(batch: pa.RecordBatch, columns: list[str], added: dict, schema: pa.Schema) -> pa.RecordBatch:
    """The batch's ``columns`` and the added arrays, cast to the schema Spark expects."""
    arrays = [batch.column(c) for c in columns]
    arrays += [a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, type=schema.field(n).type)
               for n, a in added.items()]
    arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_slices(
    df: DataFrame, column: str, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: T.StructType, most: int = SLICE_BYTES,
) -> DataFrame:
    """Run ``start()`` once a task and its result on every bounded slice of the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for part in slices(batches, column, most):
            done = work(part)
            if done is not None and done.num_rows:
                yield done
        del work
        give_back()

    return df.mapInArrow(run, schema)
