"""Small helpers on frames: Arrow maps, row numbers, and membership filters of bounded size."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "__row"
_ROOT = str(Path(__file__).resolve().parents[2])
#: Bits of a membership filter: 2^12 buckets of 2^15 bits, 16 MB.
_FILTER_BITS = 27


def reach(df: DataFrame) -> DataFrame:
    """``df``; its Python workers will find this library if it is in the same folder there."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([x for x in paths if x] + [_ROOT])
    return df


def numbered(docs: DataFrame, name: str = ROW) -> DataFrame:
    """Add a number that is unique for each row.

    It comes from the row's place in its partition, so it is the same in every pass over stored
    tables; a frame that is not a plain scan should be written out first.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} is taken")
    return docs.withColumn(name, F.monotonically_increasing_id())


def arrow_map(df: DataFrame, schema: str,
              function: Callable[[pa.RecordBatch], Iterator[dict | None] | dict | None]) -> DataFrame:
    """Apply a function of a batch to columns by name; it gives or yields dicts of columns."""
    kinds = {field.name: _arrow_type(field.dataType) for field in T.StructType.fromDDL(schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = function(batch)
            for columns in [found] if isinstance(found, dict) else found or ():
                yield pa.RecordBatch.from_arrays(
                    [_as_array(columns[name], kind) for name, kind in kinds.items()],
                    names=list(kinds))
        give_back()

    return reach(df).mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on, and several wait idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind])
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
            "smallint": pa.int16(), "tinyint": pa.int8()}[kind.simpleString()]


def _as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def binary_rows(words: np.ndarray) -> pa.Array:
    """Rows of a (n, m) array of 64-bit numbers as binary values of 8 m bytes."""
    flat = np.ascontiguousarray(words)
    width = flat.shape[1] * 8
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(flat),
                                                 [None, pa.py_buffer(flat.tobytes())])
    return fixed.cast(pa.binary())


def membership(keys: DataFrame, name: str) -> np.ndarray:
    """A bit for every key of an evenly hashed long column: 16 MB, however many keys there are.

    A key that was put in is always found, others with a chance that grows with the number of keys,
    so an exact join has to follow.
    """
    bits = keys.select((F.col(name).bitwiseAND((1 << _FILTER_BITS) - 1) + 1).alias("bit"))
    rows = (bits.groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    whole = np.zeros((1 << _FILTER_BITS) >> 3, dtype=np.uint8)
    for row in rows:
        at = (row.bucket - 1) * 4096
        whole[at:at + 4096] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return whole


def is_member(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def list_of(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """An Arrow list column from values and row bounds; 64-bit hashes become signed numbers."""
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
