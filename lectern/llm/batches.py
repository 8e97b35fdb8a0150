"""Arrow batches in pieces of bounded bytes, so that a worker's memory doesn't follow the batch's rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of batches in order, in pieces of about size bytes; a larger row is a piece by itself.

    After the last one, memory that the task has freed goes back to the system: workers live on for other
    tasks, beside which it would count.
    """
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def release() -> None:
    """Gives freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def widened(schema: StructType, **kinds: str) -> StructType:
    """schema with more columns."""
    out = StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


#: Rows that are summed in one call.
FAN_IN = 256


def summed(parts: DataFrame, keys: list[str], add: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Partial results of tasks, a row for each key and task (column lot: the task's number), added up by key.

    They are added in three levels, so that no call gets more than FAN_IN rows of a key below 16 million tasks.
    """
    for level in range(3):
        lot = F.lit(0) if level == 2 else F.expr(f"lot div {FAN_IN}").cast("int")
        parts = parts.withColumn("lot", lot).groupBy(*keys, "lot").applyInArrow(add, parts.schema)
    return parts.drop("lot")
