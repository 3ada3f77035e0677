"""What the operators of this subpackage share: table access, shared storage, packing of byte slices."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tissuemill.functions.storage import bucketed, forget, materialise, shared_dir

__all__ = ["as_int64", "bucketed", "filtered", "forget", "groups_of_rows", "lighter", "materialise", "packed", "release", "shared_dir", "table", "text_buffer", "unique_keys"]

#: Bytes of text that a task works on at once; numpy's temporaries are some ten times as large.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *without: str) -> DataFrame:
    """(doc_id, text, _row): all columns but ``without`` in one struct, so that no name of theirs meets an operator's own."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("_row"))


#: Rows of a few numbers each that may be broadcast: some tens of megabytes.
MOST_ROWS = 1 << 20


def lighter(table: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """A written table to join with, broadcast if it has up to ``most`` rows; else Spark joins it as it likes."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def release() -> None:
    """Give memory that this worker has freed back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def filtered(docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``docs`` through a function that drops rows of Arrow batches; columns go by number, so any name is good."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return plain.mapInArrow(tidy, plain.schema).toDF(*docs.columns)


def unique_keys(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with a long ``_key`` that is unique, not null and ordered as doc_id; and how results get their rows back.

    With unique, whole-numbered doc_ids the key is the doc_id. Else rows are ordered by doc_id (nulls first) and text over
    range partitions, and numbered there by partition and place: no arithmetic on ids, whatever their size or type. Rows equal
    in both come in any order. The numbers are written down with the rows, so that every later read has the same.
    """
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        seen = docs.groupBy("doc_id").count().agg(F.coalesce(F.max("count"), F.lit(1)), F.coalesce(F.count_if(F.col("doc_id").isNull()), F.lit(0))).first()
        if tuple(seen) == (1, 0):  # coalesce tells Spark that there are no nulls: no filter, equal exchanges
            keyed = docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")))
            return keyed, lambda out: keyed.drop("text").join(out, "_key")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first(), F.col("_turn")]
    ranged = docs.withColumn("_turn", F.rand(7)).repartitionByRange(*order).sortWithinPartitions(*order)
    keyed = materialise(ranged.drop("_turn").withColumn("_key", F.monotonically_increasing_id()))
    return keyed, lambda out: keyed.drop("text").join(out, "_key")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n+1 offsets of its rows; nulls are empty."""
    if pa.types.is_large_string(column.type):
        kind, width = pa.large_string(), np.int64
    else:
        kind, width = pa.string(), np.int32
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(kind)
    n, buffers = len(column), column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], width, n + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def groups_of_rows(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def as_int64(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))
