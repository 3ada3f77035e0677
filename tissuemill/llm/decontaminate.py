"""Benchmark decontamination: q-gram counts in overlapping diagonal bands, verified by banded alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from tissuemill.llm.common import filtered, groups_of_rows, text_buffer

Q = 12
#: Bytes of benchmark text that are indexed and broadcast at once; a larger benchmark goes over the documents in blocks.
BLOCK_BYTES = 4 << 20

FOLD = np.full(256, 32, np.uint8)
FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
FOLD[ord("a") : ord("z") + 1] = FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[128:] = np.arange(128, 256)


#: Case folds of characters beyond ASCII, by code point; those of as many bytes as the character also as one number.
FOLDS = {c: f for c in range(128, 0x1F000) if not 0xD800 <= c < 0xE000 and (f := chr(c).casefold()) != chr(c)}
BYTES = np.zeros(0x110000, np.uint32)
OTHER = np.zeros(0x110000, bool)
for _c, _f in FOLDS.items():
    _b = _f.encode()
    OTHER[_c] = len(_b) != len(chr(_c).encode())
    if not OTHER[_c]:
        BYTES[_c] = int.from_bytes(_b, "little")


def case_folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """UTF-8 bytes with all characters beyond ASCII case-folded, and each byte's origin where lengths have changed."""
    at = np.flatnonzero(data >= 0xC0)
    if not len(at):
        return data, None
    lead = data[at].astype(np.int64)
    width = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & (0x7F >> width)
    for k in (1, 2, 3):
        more = k < width
        code[more] = code[more] << 6 | data[at[more] + k] & 0x3F
    same = BYTES[code]
    hit = np.flatnonzero(same)
    if len(hit):
        data = data.copy()
        for k in range(4):
            own = hit[k < width[hit]]
            data[at[own] + k] = same[own] >> np.uint32(8 * k) & np.uint32(255)
    hit = np.flatnonzero(OTHER[code])
    if not len(hit):
        return data, None
    parts, origins, last = [], [], 0
    for a, n, c in zip(at[hit].tolist(), width[hit].tolist(), code[hit].tolist(), strict=True):
        new = np.frombuffer(FOLDS[c].encode(), np.uint8)
        place = np.minimum(np.arange(len(new)), n - 1)
        place[-1] = n - 1
        parts += [data[last:a], new]
        origins += [np.arange(last, a), a + place]
        last = a + n
    return np.concatenate([*parts, data[last:]]), np.concatenate([*origins, np.arange(last, len(data))])


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows' bytes case-folded and all ASCII but letters and digits as one space; new offsets; origins."""
    data, source = case_folded(data)
    if source is not None:
        offsets = np.searchsorted(source, offsets)
    size = len(data)
    folded = FOLD[data]
    blank = folded == 32
    before = np.ones(size, bool)
    before[1:] = blank[:-1]
    before[offsets[:-1][offsets[:-1] < size]] = True
    keep = ~(blank & before)
    kept = np.flatnonzero(keep)
    return folded[keep], np.searchsorted(kept, offsets), kept if source is None else source[kept]


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes from each place on."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    h = np.ndarray((n,), "<u8", padded, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h += np.ndarray((n,), "<u4", padded, 8, (1,))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h


@dataclass
class Index:
    """Passages of benchmark items, and the q-grams in them."""

    items: list  # item of each passage
    texts: list[bytes]
    edits: np.ndarray  # budget of each passage
    least: np.ndarray  # q-grams that a match within the budget must share
    names: np.ndarray  # distinct grams, sorted
    bounds: np.ndarray  # of each gram's entries
    passage: np.ndarray  # entries: passage and place in it
    place: np.ndarray
    sieve: np.ndarray
    shift: int
    short: dict[int, dict[bytes, list[int]]]  # passages under Q bytes, by size and text


def budget(size: int, rate: float) -> int:
    """Edits allowed in a passage: a share of its size, and few enough that the q-gram lemma asks for a shared gram."""
    return max(0, min(int(size * rate), (size - Q) // Q))


def build(rows: list[tuple], rate: float = 0.06, size: int = 96, step: int = 48) -> Index:
    """The index of (item_id, text) rows: each item in passages of ``size`` normalised bytes, ``step`` apart.

    An item of up to size + step bytes is one passage; one under Q bytes has no q-gram and is sought as whole words, unedited.
    """
    items, texts = [], []
    for item, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        whole = normalised(raw, np.array([0, len(raw)]))[0].tobytes().strip()
        if not whole:
            continue
        starts = [0] if len(whole) <= size + step else [*range(0, len(whole) - size, step), len(whole) - size]
        for a in starts:
            items.append(item)
            texts.append(whole if len(starts) == 1 else whole[a : a + size])
    edits = np.array([budget(len(t), rate) for t in texts], np.int64)
    least = np.array([len(t) for t in texts], np.int64) - Q + 1 - Q * edits
    found = [grams(np.frombuffer(t, np.uint8)) for t in texts]
    h = np.concatenate(found) if found else np.zeros(0, np.uint64)
    passage = np.repeat(np.arange(len(texts)), [len(x) for x in found]).astype(np.int32)
    place = np.concatenate([np.arange(len(x)) for x in found]).astype(np.int32) if found else np.zeros(0, np.int32)
    order = np.argsort(h, kind="stable")
    h, passage, place = h[order], passage[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    bits = max(16, math.ceil(math.log2(64 * max(1, len(first)))))
    sieve = np.zeros(1 << bits, bool)
    sieve[h[first] >> np.uint64(64 - bits)] = True
    short: dict[int, dict[bytes, list[int]]] = {}
    for k, t in enumerate(texts):
        if len(t) < Q:
            short.setdefault(len(t), {}).setdefault(t, []).append(k)
    return Index(items, texts, edits, least, h[first], np.concatenate((first, [len(h)])), passage, place, sieve, 64 - bits, short)


def distances(passages: list[bytes], regions: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The least edits that turn each passage into a part of its region, and where that part ends.

    Banded alignment: only the diagonals that start inside the region's surplus over the passage are kept. All passages have
    one length and all regions another; they are aligned side by side.
    """
    p = np.frombuffer(b"".join(passages), np.uint8).reshape(len(passages), -1)
    r = np.frombuffer(b"".join(regions), np.uint8).reshape(len(regions), -1)
    wide = r.shape[1] - p.shape[1] + 1
    step = np.arange(wide)
    now = np.zeros((len(p), wide), np.int64)
    for j in range(p.shape[1]):
        new = now + (p[:, j : j + 1] != r[:, j : j + wide])
        new[:, :-1] = np.minimum(new[:, :-1], now[:, 1:] + 1)
        now = np.minimum.accumulate(new - step, axis=1) + step
    best = now.argmin(axis=1)
    return now[np.arange(len(p)), best], best + p.shape[1]


def starts(passages: list[bytes], regions: list[bytes], ends: list[int], slack: int) -> np.ndarray:
    """Where the part of each region begins that ends at ``ends`` and is nearest to the passage; of equals the one of its size.

    Passage and region are aligned backwards from the end, within ``slack`` diagonals; all passages have one length.
    """
    size = len(passages[0])
    p = np.frombuffer(b"".join(x[::-1] for x in passages), np.uint8).reshape(len(passages), size)
    back = [r[max(0, e - size - slack) : e][::-1] for r, e in zip(regions, ends, strict=True)]
    r = np.frombuffer(b"".join(bytes(slack) + x + bytes(size + slack - len(x)) for x in back), np.uint8).reshape(len(passages), -1)
    step = np.arange(2 * slack + 1)
    now = np.broadcast_to(np.where(step < slack, 1 << 20, step - slack), (len(p), len(step))).copy()
    for j in range(size):
        new = now + (p[:, j : j + 1] != r[:, j : j + len(step)])
        new[:, :-1] = np.minimum(new[:, :-1], now[:, 1:] + 1)
        now = np.minimum.accumulate(new - step, axis=1) + step
    best = (now * 4 * len(step) + np.abs(step - slack)).argmin(axis=1)
    return np.array(ends) - size - (best - slack)


def _whole_words(index: Index, text: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, passage, start, end) in the normalised text for each short item that stands there between spaces."""
    out = []
    open_ = np.ones(len(text) + 1, bool)
    open_[1:-1] = (text[:-1] == 32) | (text[1:] == 32)
    open_[bounds] = True
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(text),), "<u8", padded, 0, (1,))
    for size, known in index.short.items():
        mask = np.uint64((1 << 8 * min(size, 8)) - 1)
        heads = np.array([int.from_bytes(t[:8], "little") for t in known], np.uint64)
        at = np.flatnonzero(open_[: max(0, len(text) - size + 1)] & open_[size:])
        at = at[np.isin(eight[at] & mask, heads)]
        row = np.searchsorted(bounds, at, "right") - 1
        for r, a in zip(row.tolist(), at.tolist(), strict=True):
            if a + size <= bounds[r + 1]:
                out += [(r, k, a, a + size) for k in known.get(text[a : a + size].tobytes(), ())]
    return out


def search(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, passage, start, end, edits) of every verified match in the rows; start and end are bytes of the row."""
    text, bounds, origin = normalised(data, offsets)
    found = [(r, p, a, z, 0) for r, p, a, z in _whole_words(index, text, bounds)] if index.short else []
    found += _aligned(index, text, bounds)
    return [(r, p, int(origin[a] - offsets[r]), int(origin[z - 1] - offsets[r]) + 1, e) for r, p, a, z, e in found]


def _aligned(index: Index, text: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The matches of passages with q-grams, in places of the normalised text."""
    h = grams(text)
    at = np.flatnonzero(index.sieve[h >> np.uint64(index.shift)])
    if not len(at) or not len(index.names):
        return []
    g = np.searchsorted(index.names, h[at])
    there = index.names[np.minimum(g, len(index.names) - 1)] == h[at]
    row = np.searchsorted(bounds, at, "right") - 1
    there &= at + Q <= bounds[row + 1]
    at, g, row = at[there], g[there], row[there]
    count = index.bounds[g + 1] - index.bounds[g]
    entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(index.bounds[g], count)
    passage, row, at = index.passage[entry].astype(np.int64), np.repeat(row, count), np.repeat(at, count)
    diagonal = at - index.place[entry]
    span = int(index.edits.max(initial=0)) + 1  # matches within the budget keep to so many neighbouring diagonals
    band = diagonal // span
    # bands are two spans wide and overlap by one, so that some band holds all of a match
    keys = np.stack([np.concatenate((row, row)), np.concatenate((passage, passage)), np.concatenate((band, band - 1))])
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    first = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))) if keys.shape[1] else np.zeros(0, np.int64)
    shared = np.diff(np.concatenate((first, [keys.shape[1]])))
    keys = keys[:, first]
    good = shared >= index.least[keys[1]]
    cases: dict[tuple[int, int], list] = {}
    for r, p, b in keys[:, good].T.tolist():
        size, slack = len(index.texts[p]), int(index.edits[p])
        low = b * span - slack
        high = (b + 2) * span - 1 + size + slack
        a, z = max(low, int(bounds[r])), min(high, int(bounds[r + 1]))
        region = bytes(max(0, a - low)) + text[a:z].tobytes() + bytes(max(0, high - max(z, a)))  # zeros match nothing
        cases.setdefault((size, len(region)), []).append((r, p, low, region))
    out = []
    for own in cases.values():
        for k in range(0, len(own), 512):
            part = own[k : k + 512]
            edits, ends = distances([index.texts[p] for _, p, _, _ in part], [x[3] for x in part])
            hits = []
            for (r, p, low, region), e, end in zip(part, edits.tolist(), ends.tolist(), strict=True):
                if e <= index.edits[p]:
                    hits.append((r, p, low, region, e, end))
            if not hits:
                continue
            slack = max(int(index.edits[p]) for _, p, *_ in hits)
            begins = starts([index.texts[p] for _, p, *_ in hits], [x[3] for x in hits], [x[5] for x in hits], slack)
            for (r, p, low, _, e, end), begin in zip(hits, begins.tolist(), strict=True):
                a, z = max(low + begin, int(bounds[r])), min(low + end, int(bounds[r + 1]))
                out.append((r, p, a, z, e))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The rows of a benchmark, in blocks of bounded size."""
    total = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total // BLOCK_BYTES) or 1
    for k in range(n):
        part = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [tuple(x) for x in part.select("item_id", "text").orderBy("item_id", "text").collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06) -> DataFrame:
    """(doc_id, item_id, first_byte, end_byte, passages_hit, passages, edits) for each document that holds part of an item.

    Texts are compared case-folded (all of Unicode), with all ASCII but letters and digits as single spaces. An item counts as leaked where
    one of its passages (up to 96 such bytes, or the whole of a short item) is found within ``rate`` edits a byte. By the
    q-gram lemma such a match shares at least len-Q+1-Q*edits q-grams with the passage, all in one of the overlapping
    diagonal bands; bands with as many are verified by banded alignment. Bytes are those of the original text, from the
    first to the last passage found; edits are summed over passages.

    An item under 12 such bytes is sought unedited, as whole words. Null texts hold nothing, null and blank items aren't sought;
    very long texts are searched whole; rows that repeat a doc_id or an item_id are reported row by row, each
    benchmark row for itself. No benchmark or no documents: no rows.
    """
    out = None
    spark = docs.sparkSession
    ids = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    names = ["doc_id", "item_id", "first_byte", "end_byte", "passages_hit", "passages", "edits"]
    types = [*map(to_arrow_type, ids), *[pa.int64()] * 5]
    schema = StructType([StructField(c, t) for c, t in zip(names, [*ids, *[LongType()] * 5], strict=True)])
    for rows in _blocks(benchmark):
        numbered = build([(n, text) for n, (_, text) in enumerate(rows)], rate)  # rows that repeat an item_id stay apart
        shared = spark.sparkContext.broadcast((numbered, [item for item, _ in rows]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names_of = shared.value
            total: dict = {}
            for item in index.items:
                total[item] = total.get(item, 0) + 1
            for batch in batches:
                data, offsets = text_buffer(batch.column(1))
                ids = batch.column(0)
                found: dict[tuple, list] = {}
                for i, j in groups_of_rows(offsets):
                    for r, p, a, z, e in search(index, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                        x = found.setdefault((i + r, index.items[p]), [a, z, {}])
                        x[0], x[1] = min(x[0], a), max(x[1], z)
                        x[2][p] = min(e, x[2].get(p, e))
                rows = [(ids[r].as_py(), names_of[n], a, z, len(ps), total[n], sum(ps.values())) for (r, n), (a, z, ps) in sorted(found.items())]
                cols = list(zip(*rows, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06) -> DataFrame:
    """The rows of ``docs`` that hold no part of a benchmark item; all columns stay as they are."""
    at = docs.columns.index("text")
    for rows in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(build(rows, rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_buffer(batch.column(at))
                clean = np.ones(len(offsets) - 1, bool)
                for i, j in groups_of_rows(offsets):
                    for r, *_ in search(shared.value, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                        clean[i + r] = False
                yield batch.filter(pa.array(clean))

        docs = filtered(docs, run)
    return docs
