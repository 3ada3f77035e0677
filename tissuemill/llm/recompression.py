"""Substring dedup by recompression: Spark rounds name runs and pairs of symbols for the whole corpus.

What may repeat (see ``repeats``) is cut out of the documents as stretches of words, and stretches are put into chunks of
bounded size, one row a chunk. Stretches that look alike go to neighbouring chunks; a chunk holds stretches of equal letters once,
with the places of all their copies. Symbols are numbers that stand for word sequences, equal numbers for equal sequences:

* Round 0 names words by their letters. Each chunk files its distinct words, Spark sorts them so that equal words of all chunks
  stand in a row, gives each one number, and sends the numbers back to the chunks.
* Every further round does so with runs (a symbol and how often it stands there in a row) and pairs (a left symbol followed
  by a right one; a bit drawn from the symbol and the round tells which it is). Names are given by the parts' exact
  numbers, so a number stands for one word sequence; no hash decides.
* What occurs once in the corpus gets the number 0 and is named no further.

A symbol depends on the words from ``lo`` to ``hi`` around it, which the rounds keep track of. Windows that hold all of them
have the symbol inside, wherever they stand: equal windows have equal symbols at equal places. A window that holds a
symbol of number 0 therefore repeats nowhere. Each other window is filed under some symbols of the last round inside it. Windows in a row under the same symbols are one record, verified as a whole by the numbers of all its words; where the
same symbols have records of different words, their windows are verified one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuemill.functions.storage import lists_by_hash
from tissuemill.llm.common import SLICE_BYTES, bucketed, forget, materialise, unique_keys
from tissuemill.llm.repeats import PLACES, anchored, listed, maximal, received, runs, shipped, slices, with_spans

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
LETTERS = np.random.default_rng(17).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
#: Words of a chunk.
CHUNK = 1 << 16
#: Rounds after the words' own: symbols of the last are some four words long, and a window holds what settles several of them.
ROUNDS = 5
#: Words of a gram of the sieve.
GRAM = 16
#: Copies of an anchor that go to one place; more are dealt to several.
SPREAD = 20_000
#: Neighbouring symbols that a window is filed under.
SHARED = 3
NEVER = 1 << 40
#: Lists that a task collects by hashing, some 30 MB with a few numbers each; more are sorted.
LISTS = 1 << 16


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse for i in 0..n, modulo 2**64."""
    back = np.uint64(pow(base, -1, 1 << 64))
    up, down = np.full(n + 1, np.uint64(base)), np.full(n + 1, back)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(int(base), 1 << max(20, int(n).bit_length()))


def stirred(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def spans_hashed(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of names[start:end] for each start and end. It serves the sieve only: equal spans have equal hashes."""
    up, down = powers(base, len(names))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(names * up[: len(names)], dtype=np.uint64)))
    return stirred((sums[ends] - sums[starts]) * down[starts])


def words_hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the rows, for the sieve, and the rows' n+1 offsets in the words."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    dark = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = dark.copy()
    first[1:] &= ~dark[:-1] | edge[1:-1]
    last = dark.copy()
    last[:-1] &= ~dark[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    names, step = np.zeros(len(starts), np.uint64), 4 * SLICE_BYTES
    a = 0
    while a < len(starts):  # long rows in pieces that end between words
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + step)))
        low, high = starts[a], ends[b - 1]
        names[a:b] = spans_hashed(LETTERS[data[low:high]], starts[a:b] - low, ends[a:b] - low, BASES[0])
        a = b
    return names, np.searchsorted(starts, offsets)


def sieved(keyed: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(doc, wanted): for each document, the records (pos, n, h, count) of windows whose anchor occurs more than once.

    The table of all records, which that is made of, comes second.
    """
    gram = min(GRAM, length)

    def work(keys: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
        words, bounds = words_hashed(data, offsets)
        if len(words) < length:
            return None
        at = np.arange(len(words))
        h, row, pos, n = anchored(spans_hashed(words, at, np.minimum(at + gram, len(words)), BASES[1]), bounds, length, gram)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(keys[row]), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))], ["h", "doc", "pos", "n"])

    found = materialise(slices(keyed, work, "h long, doc long, pos int, n int"))
    kept = found.join(found.groupBy("h").count().where("count > 1"), "h")
    return kept.groupBy("doc").agg(F.collect_list(F.struct("pos", "n", "h", "count")).alias("wanted")), found


#: What the lists of a chunk hold. They are packed into bytes, as Spark carries them and never looks inside.
KINDS = {"copies": np.int32, "doc": np.int64, "at": np.int64, "size": np.int64, "word": np.int64, "sym": np.int64, "wide": np.int32, "back": np.int32, "ahead": np.int32}
CHUNKS = "chunk long, copies binary, doc binary, at binary, size binary, text binary"


def _row(chunk: int, columns: dict[str, np.ndarray | bytes]) -> pa.RecordBatch:
    """A chunk's row; bytes stay as they are."""
    codec, cells = pa.Codec("lz4_raw"), []
    for name, cell in columns.items():
        if name in KINDS:
            raw = np.ascontiguousarray(cell, KINDS[name]).tobytes()
            cell = len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)
        cells.append(pa.array([cell], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *cells], ["chunk", *columns])


def _cells(batch: pa.RecordBatch, k: int) -> list:
    """The cells of a row of the batch, lists unpacked."""
    codec, out = pa.Codec("lz4_raw"), []
    for name, cell in zip(batch.schema.names, (x[k] for x in batch.columns), strict=True):
        if name in KINDS:
            raw = cell.as_buffer()
            out.append(np.frombuffer(codec.decompress(raw[8:], int.from_bytes(raw[:8].to_pybytes(), "little"), asbytes=True), KINDS[name]))
        else:
            out.append(cell.as_py())
    return out


def stretches(keyed: DataFrame, wanted: DataFrame, length: int, room: int) -> DataFrame:
    """(place, size, text, doc, at): the stretches of words that hold all wanted windows, equal ones of a batch as one row.

    Longer ones than ``room`` are cut into pieces that overlap by a window. ``place`` is the least anchor of the stretch, so
    that copies have one place; copies of a common anchor are dealt to several.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (bounds, cells), i, j, data, offsets in ((b, lists, *part) for b in batches for lists in [listed(b.column(2))] for part in received(b.column(1))):
            found: dict[bytes, tuple[int, int, list[int], list[int]]] = {}
            keys = batch.column(0)[i:j].to_numpy()
            pos, n, h, count = (x[bounds[i] : bounds[j]] for x in cells)
            order, heads, row, low, high = maximal(np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1])), pos, pos.astype(np.int64) + n + length - 1)
            h, count = h[order], count[order]
            least = np.minimum.reduceat(h, heads)
            alike = np.where(h == np.repeat(least, np.diff(np.append(heads, len(h)))), count, 0)  # an anchor has one count
            places = least + keys[row] % (1 + np.maximum.reduceat(alike, heads) // SPREAD)
            last, words = -1, []
            for k, key, b, e, place in zip(row.tolist(), keys[row].tolist(), low.tolist(), high.tolist(), places.tolist(), strict=True):
                if k != last:
                    last, words = k, data[offsets[k] : offsets[k + 1]].tobytes().split()
                for x in range(b, max(b + 1, e - length + 1), room):
                    y = min(e, x + room + length - 1)
                    held = found.setdefault(b" ".join(words[x:y]), (place, y - x, [], []))
                    held[2].append(key)
                    held[3].append(x)
            if found:
                place, size, doc, at = zip(*found.values(), strict=True)
                lists = (pa.array(x, pa.list_(pa.int64())) for x in (doc, at))
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(size, pa.int64()), pa.array(list(found), pa.binary()), *lists], ["place", "size", "text", "doc", "at"])

    texts = shipped(keyed)
    rows = texts.join(wanted, texts["_key"] == wanted["doc"]).select("_key", "text", "wanted")
    return rows.mapInArrow(run, "place long, size long, text binary, doc array<long>, at array<long>")


def chunks(keyed: DataFrame, wanted: DataFrame, length: int, room: int = CHUNK) -> DataFrame:
    """The stretches in rows of some ``room`` different words' places, or as many copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, words, copies = TaskContext.get().partitionId(), 0, 0, 0
        held: dict[bytes, tuple[int, list[int], list[int]]] = {}

        def row() -> pa.RecordBatch:
            size, doc, at = zip(*held.values(), strict=True)
            places = {n: np.fromiter(chain.from_iterable(x), np.int64) for n, x in (("doc", doc), ("at", at))}
            return _row(part << 32 | made, {"copies": [len(d) for d in doc], **places, "size": size, "text": b" ".join(held)})

        for batch in batches:
            for size, text, doc, at in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if text not in held:
                    held[text] = (size, [], [])
                    words += size
                held[text][1].extend(doc)
                held[text][2].extend(at)
                copies += len(doc)
                if words >= room or copies >= room:
                    yield row()
                    made, words, copies = made + 1, 0, 0
                    held = {}
        if held:
            yield row()

    dealt = stretches(keyed, wanted, length, room).repartition("place").sortWithinPartitions("place")
    return bucketed(dealt.select("size", "text", "doc", "at").mapInArrow(run, CHUNKS), "chunk")


def _each(df: DataFrame, work: Callable[..., pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` over rows of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                out = work(*_cells(batch, k))
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def _filed(chunk: int, columns: dict[str, np.ndarray | list]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    cols = [pa.array(np.full(n, chunk)), pa.array(np.arange(n, dtype=np.int32)), *[c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]]
    return pa.RecordBatch.from_arrays(cols, ["chunk", "nth", *columns])


def _in_a_row(filed: DataFrame, keys: list[str], order: list[str], run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``run`` over partitions by ``keys`` where equal keys stand in a row: a key's rows are never held together, nor made a list."""
    return filed.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _fresh(columns: list[pa.Array]) -> np.ndarray:
    """Which rows differ from the one before in some column; the first does."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns], axis=0)
    return out


def _after(last: list[pa.Array], batch: pa.RecordBatch) -> list[pa.Array]:
    """The batch's columns behind those of the row ``last``, if there is one."""
    return [pa.concat_arrays(x) for x in zip(last, batch.columns, strict=True)] if last else batch.columns


def named(filed: DataFrame, keys: list[str]) -> DataFrame:
    """One number for each distinct key of all chunks that occurs more than once: (chunk, nth, id).

    ``filed``: (chunk, nth, keys, n). Each chunk files a key once, so that a key has a row for each chunk at most. A number is that
    of the partition and how many of its keys have got one before, in order: a task that runs again gives the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, last, own = TaskContext.get().partitionId() << 33, [], 0  # the row before; its number, 0 where it stands alone so far
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _after(last, batch)
            fresh = _fresh(columns[2:-1])
            group, heads = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
            good = (np.diff(np.append(heads, len(group))) > 1) | (columns[-1].to_numpy()[heads] > 1)
            new = good.copy()
            new[0] &= not own
            number = np.where(good, given + np.cumsum(new), 0)
            if own:
                good[0], number[0] = True, own
            given += int(new.sum())
            out = good[group]
            out[0] &= not own  # it has gone out already
            at = np.flatnonzero(out)
            if len(at):
                yield pa.RecordBatch.from_arrays([columns[0].take(pa.array(at)), columns[1].take(pa.array(at)), pa.array(number[group[at]])], ["chunk", "nth", "id"])
            last, own = [c[-1:] for c in columns], int(number[-1])

    return _in_a_row(filed.select("chunk", "nth", *keys, "n"), keys, [], run, "chunk long, nth int, id long")


def _met(chunked: DataFrame, back: DataFrame, work: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` over each chunk's row and the columns of its rows in ``back``, as arrays; they may be empty."""

    def run(chunk: pa.Table, rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([work(*_cells(chunk.combine_chunks().to_batches()[0], 0), *[rows[c].to_numpy() for c in back_columns])])

    back_columns = back.columns[1:]
    return chunked.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(run, schema)


def numbered(count: int, nth: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The number of each key that a chunk has filed; 0 for those that occur nowhere else."""
    out = np.zeros(count, np.int64)
    out[nth] = ids
    return out


def _first_seen(words: list[bytes]) -> tuple[list[int], dict[bytes, int]]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(w, len(seen)) for w in words], seen


WORDS = "chunk long, copies binary, doc binary, at binary, size binary, word binary"


def words_named(chunked: DataFrame) -> DataFrame:
    """Round 0: the chunks with the number of each word."""

    def need(chunk: int, copies: np.ndarray, size: np.ndarray, text: bytes) -> pa.RecordBatch:
        nth, seen = _first_seen(text.split())
        n = np.bincount(nth, np.repeat(copies, size), len(seen)).astype(np.int64)
        return _filed(chunk, {"key": pa.array(list(seen), pa.binary()), "n": n})

    def give(chunk: int, copies: np.ndarray, doc: np.ndarray, at: np.ndarray, size: np.ndarray, text: bytes, nth: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        place, seen = _first_seen(text.split())
        return _row(chunk, {"copies": copies, "doc": doc, "at": at, "size": size, "word": numbered(len(seen), nth, ids)[place]})

    back = named(_each(chunked.select("chunk", "copies", "size", "text"), need, "chunk long, nth int, key binary, n long"), ["key"])
    out = bucketed(_met(chunked, back, give, WORDS), "chunk")
    forget(chunked)
    return out


def draws(sym: np.ndarray, count: np.ndarray, turn: int) -> np.ndarray:
    """For each run: whether it is a right one in this round (else a left one)."""
    x = sym.astype(np.uint64) * BASES[0] + count.astype(np.uint64) * BASES[1] + np.uint64(turn)
    return (stirred(x) & np.uint64(1)).astype(bool)


class Parse:
    """The symbols of a chunk: number, first and end word, and the words from lo to hi that settle each."""

    def __init__(self, sym: np.ndarray, start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, fence: np.ndarray):
        self.sym, self.start, self.end, self.lo, self.hi, self.fence = sym, start, end, lo, hi, fence

    @classmethod
    def of_words(cls, word: np.ndarray, size: np.ndarray) -> Parse:
        at = np.arange(len(word))
        return cls(word, at, at + 1, at, at + 1, np.concatenate(([0], np.cumsum(size))))

    def _around(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each symbol, whether its stretch begins with it; lo of the one before, hi of the one after it."""
        opens = np.zeros(len(self.start), bool)
        opens[np.searchsorted(self.start, self.fence[:-1])] = True
        closes = np.append(opens[1:], True)
        before = np.where(opens, self.start - 1, np.concatenate(([0], self.lo[:-1])))  # a word outside the stretch: no window holds it
        after = np.where(closes, self.end + 1, np.concatenate((self.hi[1:], [0])))
        return opens, before, after

    def runs(self) -> tuple[Parse, np.ndarray]:
        """Equal neighbours as one symbol of the same number; how many they were."""
        if not len(self.sym):
            return self, np.zeros(0, np.int64)
        opens, before, after = self._around()
        same = np.zeros(len(self.sym), bool)
        same[1:] = (self.sym[1:] == self.sym[:-1]) & (self.sym[1:] != 0) & ~opens[1:]
        head = np.flatnonzero(~same)
        tail = np.append(head[1:], len(same)) - 1
        alone = self.sym[head] == 0
        lo = np.where(alone, self.lo[head], before[head])
        hi = np.where(alone, self.hi[tail], after[tail])
        return Parse(self.sym[head], self.start[head], self.end[tail], lo, hi, self.fence), tail - head + 1

    def step(self, turn: int) -> tuple[Parse, np.ndarray, np.ndarray]:
        """A round: the parse after it, the places of symbols that want a name, and their parts: two symbols, two counts."""
        now, count = self.runs()
        opens, before, after = now._around()
        right = draws(now.sym, count, turn)
        live = now.sym != 0
        joint = np.zeros(len(right), bool)
        joint[:-1] = live[:-1] & live[1:] & ~opens[1:] & ~right[:-1] & right[1:]
        head = np.ones(len(right), bool)
        head[1:] = ~joint[:-1]
        at = np.flatnonzero(head)
        paired = joint[at]
        last = at + paired
        lone = ~paired & live[at]
        lo = np.where(lone & right[at], before[at], now.lo[at])  # a right one alone: the one before isn't a left one
        hi = np.where(lone & ~right[at], after[at], now.hi[last])
        new = Parse(now.sym[at].copy(), now.start[at], now.end[last], lo, hi, now.fence)
        want = np.flatnonzero(paired | (live[at] & (count[at] > 1)))
        a, b, both = at[want], last[want], paired[want]
        parts = np.stack([now.sym[a], np.where(both, now.sym[b], 0), count[a], np.where(both, count[b], 0)])
        return new, want, parts


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct columns of ``parts`` in order, and each column's place among them."""
    order = np.lexsort(parts[::-1])
    sorted_ = parts[:, order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_[:, 1:] != sorted_[:, :-1]).any(axis=0)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return sorted_[:, fresh], place


STATE = "chunk long, copies binary, size binary, sym binary, wide binary, back binary, ahead binary"


def _packed_state(chunk: int, copies: np.ndarray, size: np.ndarray, p: Parse) -> pa.RecordBatch:
    return _row(chunk, {"copies": copies, "size": size, "sym": p.sym, "wide": p.end - p.start, "back": p.start - p.lo, "ahead": p.hi - p.end})


def _unpacked(size: np.ndarray, sym: np.ndarray, wide: np.ndarray, back: np.ndarray, ahead: np.ndarray) -> Parse:
    end = np.cumsum(wide, dtype=np.int64)
    start = end - wide
    return Parse(sym, start, end, start - back, end + ahead, np.concatenate(([0], np.cumsum(size))))


def rounds(words: DataFrame, turns: int = ROUNDS) -> DataFrame:
    """The chunks' symbols after ``turns`` rounds, each a naming of all runs and pairs of the corpus."""

    def begin(chunk: int, copies: np.ndarray, size: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
        return _packed_state(chunk, copies, size, Parse.of_words(word, size))

    state = bucketed(_each(words.select("chunk", "copies", "size", "word"), begin, STATE), "chunk")
    for turn in range(turns):

        def need(chunk: int, copies: np.ndarray, size: np.ndarray, *cells: np.ndarray, turn: int = turn) -> pa.RecordBatch | None:
            new, want, parts = _unpacked(size, *cells).step(turn)
            keys, place = _distinct(parts)
            each = copies[np.searchsorted(new.fence, new.start[want], "right") - 1]
            n = np.bincount(place, each, keys.shape[1]).astype(np.int64)
            return _filed(chunk, {"a": keys[0], "b": keys[1], "ns": keys[2] << 32 | keys[3], "n": n}) if len(n) else None

        def give(chunk: int, copies: np.ndarray, size: np.ndarray, sym: np.ndarray, wide: np.ndarray, back: np.ndarray, ahead: np.ndarray, nth: np.ndarray, ids: np.ndarray, turn: int = turn) -> pa.RecordBatch:
            new, want, parts = _unpacked(size, sym, wide, back, ahead).step(turn)
            keys, place = _distinct(parts)
            new.sym[want] = numbered(keys.shape[1], nth, ids)[place]
            return _packed_state(chunk, copies, size, new)

        names = named(_each(state, need, "chunk long, nth int, a long, b long, ns long, n long"), ["a", "b", "ns"])
        before, state = state, bucketed(_met(state, names, give, STATE), "chunk")
        forget(before)
    return state


def _least_between(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of keys[low:high] for each low and high; there must be one."""
    size = high - low
    level = np.frexp(size.astype(np.float64))[1] - 1
    out, table = np.empty(len(low), keys.dtype), keys
    for k in range(int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def _records(p: Parse, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records of windows in a row under the same symbols: first window, how many, the symbols' key (0: none), stretch.

    A window is filed under ``SHARED`` neighbouring symbols that are settled in it, of all such the ones of least hash; one
    with fewer settled symbols stands alone.
    """
    stretch = np.repeat(np.arange(len(p.fence) - 1), np.diff(p.fence))
    start = np.arange(len(stretch))
    once = p.sym == 0
    may = (start + length <= p.fence[1:][stretch]) & (np.append(p.hi[once], NEVER)[np.searchsorted(p.lo[once], start)] > start + length)
    at = np.flatnonzero(may)
    if not len(at):
        return at, at, at, at
    low, high = np.searchsorted(p.lo, at), np.searchsorted(p.hi, at + length, "right") - SHARED + 1
    under = np.full(len(at), -1)
    some = np.flatnonzero(high > low)
    if len(some):
        place = np.arange(len(p.sym) - SHARED + 1)
        hashes = spans_hashed(p.sym.astype(np.uint64), place, place + SHARED, BASES[1])
        under[some] = (_least_between(hashes & ~PLACES | place.astype(np.uint64), low[some], high[some]) & PLACES).astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(at) != 1) | (np.diff(under) != 0) | (under[1:] < 0) | (np.diff(stretch[at]) != 0)
    heads = np.flatnonzero(fresh)
    n = np.diff(np.append(heads, len(at)))
    at, under = at[heads], under[heads]
    key = np.zeros(len(at), np.uint64)
    if len(some):
        key[under >= 0] = hashes[under[under >= 0]] | np.uint64(1)
    return at, n, key.view(np.int64), stretch[at]


def digests(word: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 128-bit BLAKE2 digest of the word numbers from each start to its end: n x 2."""
    view = memoryview(np.ascontiguousarray(word)).cast("B")
    return np.frombuffer(b"".join([hashlib.blake2b(view[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), np.int64).reshape(-1, 2)


def _least(values: np.ndarray, place: np.ndarray, count: int) -> np.ndarray:
    low = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(low, place, values)
    return low


PARSED = ["chunk", "copies", "doc", "at", "size", "word", "sym", "wide", "back", "ahead"]


def covered_spans(words: DataFrame, state: DataFrame, length: int) -> DataFrame:
    """Spans (doc, b, e), in words, of the windows that also start in a document with a smaller key."""
    parsed = words.join(state.drop("size", "copies"), "chunk").select(*PARSED)

    def cases(copies, doc, size, word, sym, wide, back, ahead):
        """Records (first, n, stretch), their distinct keys and places in those, and each stretch's least document."""
        first, n, number, stretch = _records(_unpacked(size, sym, wide, back, ahead), length)
        keys, place = _distinct(np.concatenate([[number], digests(word, first, first + n + length - 1).T]))
        return first, n, stretch, keys, place, np.minimum.reduceat(doc, np.cumsum(copies) - copies)

    def file_records(chunk, copies, doc, at, *cells) -> pa.RecordBatch | None:
        first, _, stretch, keys, place, least = cases(copies, doc, *cells)
        return _filed(chunk, dict(zip(("number", "k1", "k2"), keys, strict=True)) | {"low": _least(least[stretch], place, keys.shape[1])}) if len(first) else None

    filed = _each(parsed, file_records, "chunk long, nth int, number long, k1 long, k2 long, low long")
    def least_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A record's words stand in a row, the least document that has them first: it goes to all of them."""
        last: list[pa.Array] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, skip = _after(last, batch), len(last) and 1
            fresh = _fresh(columns[2:5])
            low = columns[5].to_numpy()[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            yield pa.RecordBatch.from_arrays([*(c[skip:] for c in columns[:3]), pa.array(low[skip:]), pa.array(fresh[skip:])], ["chunk", "nth", "number", "low", "first"])
            last = [c[-1:] for c in columns[:5]] + [pa.array(low[-1:])]

    whole = materialise(_in_a_row(filed, ["number", "k1", "k2"], ["low"], least_first, "chunk long, nth int, number long, low long, first boolean"))
    # whether others stand under a record's symbols
    many = whole.where("number <> 0 and first").groupBy("number").count().where("count > 1").select(F.col("number").alias("many"))
    told = whole.join(many, whole["number"] == many["many"], "left").select("chunk", "nth", "low", F.col("many").isNotNull().alias("several"))

    def judge(chunk, copies, doc, at, size, word, sym, wide, back, ahead, nth, low, several) -> pa.RecordBatch:
        """The spans that records settle, and the single windows of records that don't: one row for each distinct window."""
        first, n, stretch, keys, place, least = cases(copies, doc, size, word, sym, wide, back, ahead)
        lowest, more = np.empty(keys.shape[1], np.int64), np.empty(keys.shape[1], bool)
        lowest[nth], more[nth] = low, several
        gone = least[stretch] > lowest[place]
        inside = np.repeat(np.arange(len(size)), size)
        begins, heads = np.cumsum(size) - size, np.cumsum(copies) - copies

        def together(b: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Maximal spans of a stretch, ordered by stretch: their stretches, and begins and ends in them."""
            steps = np.bincount(b, minlength=len(inside) + 1) - np.bincount(e, minlength=len(inside) + 1)
            x, y = runs(np.cumsum(steps)[:-1] > 0, inside)
            return inside[x], x - begins[inside[x]], y + 1 - begins[inside[x]]

        owner = np.repeat(np.arange(len(size)), copies)
        end = first + n + length - 1
        out = []
        # the least document of a stretch loses what smaller ones have; its copies in other documents lose all that it has
        for mine, (s, x, y) in ((doc == least[owner], together(first[gone], end[gone])), (doc > least[owner], together(first, end))):
            per = np.bincount(s, minlength=len(size))[owner[mine]]
            k = np.repeat(np.searchsorted(s, owner[mine]), per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            shift = np.repeat(at[mine], per)
            out.append((np.repeat(doc[mine], per), x[k] + shift, y[k] + shift))
        spans = [np.concatenate(x) for x in zip(*out, strict=True)]

        open_ = ~gone & more[place]
        own = n[open_]
        start = np.repeat(first[open_], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        # all places of a window in the least documents of its stretches
        of = np.repeat(stretch[open_], own)
        firsts = [np.flatnonzero(doc[a:z] == d) + a for a, z, d in zip(heads.tolist(), (heads + copies).tolist(), least.tolist(), strict=True)]
        per = np.array([len(f) for f in firsts])
        member = np.concatenate(firsts)
        k = np.repeat((np.cumsum(per) - per)[of], per[of]) + np.arange(per[of].sum()) - np.repeat(np.cumsum(per[of]) - per[of], per[of])
        window = np.repeat(np.arange(len(start)), per[of])
        owners, places = doc[member[k]], at[member[k]] + (start - begins[of])[window]
        single, where = _distinct(digests(word, start, start + length).T)
        by = np.argsort(where[window], kind="stable")
        ends = np.concatenate(([0], np.cumsum(np.bincount(where[window], minlength=single.shape[1])))).astype(np.int32)
        held = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(owners[by]), pa.array(places[by])], ["doc", "b"]))
        m, k = len(spans[0]), single.shape[1]
        cols = [np.full(m + k, chunk), np.concatenate((np.full(m, -1), np.arange(k)))]
        void, empty = pa.nulls(k, pa.int64()), pa.nulls(m, pa.int64())
        cols = [*map(pa.array, cols), *[pa.concat_arrays([pa.array(x), void]) for x in spans], *[pa.concat_arrays([empty, pa.array(x)]) for x in single], pa.concat_arrays([pa.nulls(m, held.type), held])]
        return pa.RecordBatch.from_arrays(cols, ["chunk", "nth", "doc", "b", "e", "k1", "k2", "held"])

    judged = materialise(_met(parsed, told, judge, "chunk long, nth long, doc long, b long, e long, k1 long, k2 long, held array<struct<doc:long,b:long>>"))
    forget(words, state, whole)
    single = judged.where("nth >= 0").select("chunk", "nth", "k1", "k2", F.array_min("held.doc").alias("low"), F.array_max("held.doc").alias("high"))
    equal = single.groupBy("k1", "k2").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list(F.struct("chunk", "nth")).alias("where")).where("low < high")
    equal = equal.select("low", F.explode("where").alias("w")).select("w.*", "low")
    late = judged.where("nth >= 0").select("chunk", "nth", "held").join(equal, ["chunk", "nth"]).select("low", F.explode("held").alias("x")).where("x.doc > low")
    return judged.where("nth < 0").select("doc", "b", "e").union(late.select("x.doc", "x.b", (F.col("x.b") + length).alias("e")))


def removal_spans(keyed: DataFrame, length: int = 50, turns: int = ROUNDS, room: int = CHUNK) -> DataFrame:
    """Spans (doc, b, e), in words, that windows found in a smaller document cover."""
    with lists_by_hash(keyed.sparkSession, LISTS):
        wanted, found = sieved(keyed, length)
        chunked = chunks(keyed, wanted, length, room)
        forget(found)
        words = words_named(chunked)
        return covered_spans(words, rounds(words, turns), length)


def dedup(docs: DataFrame, length: int = 50, turns: int = ROUNDS, room: int = CHUNK) -> DataFrame:
    """Of every text of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Words are runs without ASCII white space; each word is removed that lies in a window of ``length`` words whose words
    also stand in a document with a smaller doc_id, judged on the input; kept words are joined by one space. Null texts
    have no words; texts under ``length`` words stay whole. A very long text is cut into pieces of ``room`` words that overlap
    by a window. Rows that repeat a doc_id count as different documents, ordered by text; a null doc_id is the smallest.
    Repeats inside one document stay. Other columns aren't looked at; an empty table gives no rows.
    """
    keyed, ids = unique_keys(docs.select("doc_id", "text"))
    pure = keyed.select("_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (bounds, cells), i, j, data, offsets in ((b, lists, *part) for b in batches for lists in [listed(b.column(2))] for part in received(b.column(1))):
            total, removed, kept = [], [], []
            _, _, row, low, high = maximal(np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1])), *(x[bounds[i] : bounds[j]] for x in cells))
            spans, cuts = list(zip(low.tolist(), high.tolist(), strict=True)), np.searchsorted(row, np.arange(j - i + 1)).tolist()
            for k in range(j - i):
                words = data[offsets[k] : offsets[k + 1]].tobytes().split()
                found = spans[cuts[k] : cuts[k + 1]]
                total.append(len(words))
                removed.append(sum(e - b for b, e in found))
                edges = [0, *[x for r in found for x in r], len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]] if found else words
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["_key", "n_words", "n_removed", "kept_sha256"])

    out = with_spans(pure, removal_spans(pure, length, turns, room)).mapInArrow(run, "_key long, n_words long, n_removed long, kept_sha256 string")
    return ids(out).select("doc_id", "n_words", "n_removed", "kept_sha256")
