"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, kept in text order, tuples hashed to signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.llm.common import materialise, text_buffer
from tissuemill.llm.recompression import stirred

K, PARTS = 6, 64
_rng = np.random.default_rng(2019)
WEIGHTS = _rng.integers(0, 1 << 63, K, np.uint64) * np.uint64(2) + np.uint64(1)
FLIPS = _rng.integers(0, 1 << 32, PARTS, np.uint32)
FACTORS = _rng.integers(0, 1 << 31, PARTS, np.uint32) * np.uint32(2) + np.uint32(1)
SALTS = _rng.integers(0, 1 << 63, PARTS, np.uint64)


def _kmers(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each k-mer; a shorter text is one k-mer, an empty one has none."""
    if len(points) < K:
        points = np.concatenate((points, np.full(K - len(points), 0x110000, points.dtype))) if len(points) else points
    n = len(points) - K + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = points[:n] * WEIGHTS[0]
    for j in range(1, K):
        h += points[j : j + n] * WEIGHTS[j]
    return stirred(h)


def _numbered(kmers: np.ndarray) -> np.ndarray:
    """For each k-mer, how many equal ones stand before it in the text."""
    n = len(kmers)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    key = ((kmers >> bits) << bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    name, at = key >> bits, (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.concatenate(([True], name[1:] != name[:-1]))
    place = np.arange(n)
    out = np.empty(n, np.uint64)
    out[at] = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return out


def signature(points: np.ndarray) -> np.ndarray:
    """PARTS 16-bit numbers. ``points``: the text's code points as uint64.

    For each part, the two k-mer occurrences of least hash are taken; their k-mers, in text order, are hashed together.
    """
    kmers = _kmers(points)
    n = len(kmers)
    if n == 0:
        return np.zeros(PARTS, np.uint16)
    base = (stirred(kmers + _numbered(kmers) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    first, second = np.empty(PARTS, np.int64), np.empty(PARTS, np.int64)
    step = max(1, min(PARTS, (1 << 16) // n))
    room = np.empty((step, n), np.uint32)
    for a in range(0, PARTS, step):
        v = room[: min(step, PARTS - a)]
        np.bitwise_xor(base[None, :], FLIPS[a : a + step, None], out=v)
        np.multiply(v, FACTORS[a : a + step, None], out=v)
        i = v.argmin(axis=1)
        first[a : a + step] = i
        v[np.arange(len(i)), i] = 0xFFFFFFFF
        second[a : a + step] = v.argmin(axis=1)
    low, high = np.minimum(first, second), np.maximum(first, second)
    return (stirred(kmers[low] * WEIGHTS[0] + stirred(kmers[high] + SALTS)) >> np.uint64(48)).astype(np.uint16)


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)


def _edited(own: np.ndarray, following: np.ndarray) -> np.ndarray:
    half = len(own) // 2
    return np.concatenate((own[: len(own) - half], following[:half]))


def _row(doc_id: int | None, own: tuple, following: tuple) -> tuple:
    """A result row of a document and the next one, each (points, signature)."""
    points, mark = own
    edited = _edited(points, following[0])
    other = signature(edited.astype(np.uint64))
    sha = hashlib.sha256(edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(points), sha, mark.tobytes(), other.tobytes(), float((mark == other).mean()), float((mark == following[1]).mean())


ROW = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
NAMES = ["doc_id", *(x.split()[0] for x in ROW.split(", "))]
TYPES = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _arrays(rows: list[tuple], ids: pa.DataType) -> list[pa.Array]:
    types = [ids, *TYPES]
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order: all but the last meet their next; head and last go out as the partition's edge."""
    held = head = ids = None
    rows: list[tuple] = []

    def out(rows: list[tuple], edge: tuple | None = None) -> pa.RecordBatch:
        n, more = len(rows), edge is not None
        cols = [pa.concat_arrays([c, pa.nulls(int(more), c.type)]) for c in _arrays(rows, ids)]
        part = TaskContext.get().partitionId()
        extra = [pa.array([None] * n + [x] * more, t) for x, t in zip((part, *(edge or (None,) * 3)), (pa.int64(), pa.binary(), ids, pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays([*cols, *extra], [*NAMES, "part", "head", "last_id", "last"])

    for batch in batches:
        ids = batch.column(0).type
        data, offsets = text_buffer(batch.column(1))
        for k, doc_id in enumerate(batch.column(0).to_pylist()):
            raw = data[offsets[k] : offsets[k + 1]].tobytes()
            points = _points(raw)
            now = (points, signature(points.astype(np.uint64)))
            if held is None:
                head = raw
            else:
                rows.append(_row(held[0], held[1], now))
            held = (doc_id, now, raw)
            if len(rows) >= 1000:
                yield out(rows)
                rows = []
    if held is not None:
        yield out(rows, (head, held[0], held[2]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Of every text of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars/2) code points replaced by the first as many (or all) of the next document,
    in descending doc_id; after the last comes the first. A fingerprint is 64 numbers of 16 bits in hex; likeness is the part
    of the numbers that agree, an estimate that falls with the edit distance. Null texts are empty; empty texts share one
    fingerprint. Rows that repeat a doc_id follow each other by text; a null doc_id comes last; ids may be of any type that can be
    sorted. A single document is
    its own next.

    Documents are ranged by doc_id, and each task holds one document besides the one it reads. A partition's last document
    waits for the next partition's first: partition numbers go through a window of their own, the two texts through a join. A
    very long text is fingerprinted whole, in the task that holds it.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)
    done = materialise(ranged.mapInArrow(_in_order, f"doc_id {kind}, {ROW}, part long, head binary, last_id {kind}, last binary"))
    edges = done.where("part is not null").select("part", "head", "last_id", "last")
    # only the partitions' numbers meet in one place: one for each; texts go by a join
    everyone = Window.orderBy("part")
    first = F.first("part").over(everyone.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turns = edges.select("part").withColumn("next", F.coalesce(F.lead("part").over(everyone), first))
    heads = edges.select(F.col("part").alias("next"), F.col("head").alias("following"))
    pairs = edges.select("part", "last_id", "last").join(turns, "part").join(heads, "next").select("last_id", "last", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, last, following in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                a, b = _points(last), _points(following)
                rows.append(_row(doc_id, (a, signature(a.astype(np.uint64))), (b, signature(b.astype(np.uint64)))))
            yield pa.RecordBatch.from_arrays(_arrays(rows, batch.column(0).type), NAMES)

    whole = done.where("part is null").select(*NAMES).union(pairs.mapInArrow(close, f"doc_id {kind}, {ROW}"))
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")}
    return whole.select(*[text.get(c, F.col(c)) for c in NAMES])
