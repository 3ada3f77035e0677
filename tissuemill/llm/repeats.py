"""What the two removers of repeated windows share: a sieve that keeps what may repeat, and spans that go back to texts.

A window is ``length`` consecutive units (bytes, words) of one document. Each window has one anchor: of the grams inside it
the one of least hash. Equal windows have equal anchors. Consecutive windows with one anchor make a record (h, doc, pos, n):
the anchor's hash and where the windows start, one record for some tens of units. A window whose h occurs once in the
corpus equals no other. So the sieve only ever drops windows that can't repeat; what stays is judged by each operator's
own method, whatever the hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuemill.llm.common import groups_of_rows, release, text_buffer

PLACES = np.uint64((1 << 20) - 1)
#: Units of a row that are worked on at once; longer rows go in pieces that overlap by a window.
PIECE = 1 << 19
#: Compression of texts on their way, and bytes of texts that are unpacked at once.
LEVEL, SHIPMENT = 1, 4 << 20


def sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    return np.minimum(key[: len(key) - (width - size)], key[width - size :]) if size < width else key


def anchored(hashes: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(h, row, pos, n) of the records of rows that lie end to end; ``hashes``: one for the gram at each unit."""
    total, out = len(hashes), []
    for a in range(0, max(1, total), PIECE):
        z = min(total, a + PIECE + length - 1)
        if z - a < length:
            break
        own = hashes[a:z]
        key = (own & ~PLACES) | np.arange(z - a, dtype=np.uint64)
        least = sliding_least(key, length - gram + 1)[: z - a - length + 1]
        anchor = (least & PLACES).astype(np.int32)
        for end in bounds[np.searchsorted(bounds, a, "right") : np.searchsorted(bounds, z)].tolist():  # no window over the end of a row
            anchor[max(0, end - a - length + 1) : end - a] = -1
        first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        n = np.diff(np.concatenate((first, [len(anchor)])))
        good = anchor[first] >= 0
        first, n = first[good], n[good]
        row = np.searchsorted(bounds, first + a, "right") - 1
        out.append((own[anchor[first]] >> np.uint64(16), row, first + a - bounds[row], n))
        if z == total:
            break
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)


def slices(keyed: DataFrame, work: Callable[[np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` over slices of (_key, text): keys, bytes, offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups_of_rows(offsets):
                out = work(keys[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if out is not None:
                    yield out
        release()

    return keyed.mapInArrow(run, schema)


def shipped(keyed: DataFrame) -> DataFrame:
    """(_key, text) with texts compressed one by one, as they go through shuffles; a null text as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=LEVEL)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            view = memoryview(np.ascontiguousarray(data))
            for i, j in groups_of_rows(offsets, 8 << 20):
                packed = [(b - a).to_bytes(4, "little") + codec.compress(view[a:b], asbytes=True) for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(packed, pa.binary())], ["_key", "text"])
        release()

    return keyed.select("_key", "text").mapInArrow(run, "_key long, text binary")


def received(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The texts of a shipped column, some at a time: first and end row, their bytes, and the rows' offsets in them."""
    codec, i = pa.Codec("zstd"), 0
    while i < len(column):
        texts, size, j = [], 0, i
        while j < len(column) and (j == i or size < SHIPMENT):
            raw = column[j].as_buffer()
            n = int.from_bytes(raw[:4].to_pybytes(), "little")
            texts.append(codec.decompress(raw[4:], n, asbytes=True))
            size, j = size + n, j + 1
        yield i, j, np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        i = j


def with_spans(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """(_key, shipped text, spans): every row of ``keyed`` with its list of spans, null where there are none."""
    keyed = shipped(keyed)
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    return keyed.join(lists, keyed["_key"] == lists["doc"], "left").select("_key", "text", "spans")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or adjoining spans, in order."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((b, e))
    return out


def maximal(row: np.ndarray, b: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
    """``merged`` for the spans of many rows: order of the spans, where runs begin in it, and row, begin and end of each run."""
    order = np.lexsort((b, row))
    row, b, e = row[order], b[order].astype(np.int64), e[order].astype(np.int64)
    if not len(row):
        return order, order, row, b, e
    shift = row.astype(np.int64) << 40  # no span of a row reaches the next row's
    fresh = np.ones(len(row), bool)
    fresh[1:] = (b + shift)[1:] > np.maximum.accumulate(e + shift)[:-1]
    heads = np.flatnonzero(fresh)
    return order, heads, row[heads], b[heads], np.maximum.reduceat(e, heads)


def listed(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The n+1 bounds of a column's lists of structs, null lists empty, and the structs' fields."""
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
    return bounds, [x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten()]


def runs(hit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true neighbours of one group."""
    at = np.flatnonzero(hit)
    if not len(at):
        return at, at
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(group[at]) != 0)) + 1
    return at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))]
