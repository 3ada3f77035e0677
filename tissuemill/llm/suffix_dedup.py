"""Suffix-array dedup: suffixes sorted in two stages, adjacent common prefixes, repeated byte strings cut out.

What may repeat (see ``repeats``) is filed as records of windows under their anchor. All records of one anchor go into one
suffix array, each content once: copies of a content (one anchor, length and 128-bit digest of all bytes) have one entry
with the first of them. Suffixes that share ``length`` bytes or more with their neighbour in the array are equal windows, and
all but the first of those are covered. A content's verdict holds for its copies: those after the first are covered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuemill.llm.common import forget, groups_of_rows, materialise, packed, release, text_buffer, unique_keys
from tissuemill.llm.repeats import anchored, merged, received, runs, shipped, with_spans

GRAM = 24
#: Contents of one anchor that go into one suffix array by the anchor; beyond, each window goes by its own bytes.
HOT = 5_000
#: Bytes of a suffix array, if no single anchor has more. Direct sorting copies 100 bytes for about each second one.
CHUNK = 1 << 19
#: Records of a row batch that go on at once, some 4 MB of text: a task's memory goes by them.
RECORDS = 100_000


def _mixed(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each place on (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(GRAM, np.uint8)))
    h = np.ndarray((len(data),), "<u8", padded, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += np.ndarray((len(data),), "<u8", padded, 8, (1,))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += np.ndarray((len(data),), "<u8", padded, 16, (1,))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    view, digest = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), np.int64).reshape(-1, 2)


def _contents(h: np.ndarray, c: np.ndarray, doc: np.ndarray, pos: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A batch's records, one row for each content: its first place, and the others as ``dups``."""
    order = np.lexsort((pos, doc, c[:, 1], c[:, 0], h))
    h, c, doc, pos, n = h[order], c[order], doc[order], pos[order], n[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1]).any(axis=1)
    first, more = np.flatnonzero(fresh), np.flatnonzero(~fresh)
    per = np.diff(np.append(first, len(h))) - 1
    dups = pa.StructArray.from_arrays([pa.array(doc[more]), pa.array(pos[more])], ["doc", "pos"])
    bounds = np.concatenate(([0], np.cumsum(per))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds, mask=np.concatenate((per == 0, [False]))), dups)
    cols = [h[first].view(np.int64), c[first, 0], c[first, 1], doc[first], pos[first], n[first].astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), lists], ["h", "c1", "c2", "doc", "pos", "n", "dups"])


def _records_of(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For some texts of (_key, text) at a time: their bytes, and each record's h, key, pos, n and first byte."""
    keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    data, offsets = text_buffer(batch.column(1))
    for i, j in groups_of_rows(offsets):
        own, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if len(own) >= length:
            h, row, pos, n = anchored(_mixed(own), bounds, length, GRAM)
            yield own, h, keys[i:j][row], pos, n, bounds[row] + pos


def record_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The records of batches of (_key, text), contents told apart within some ``RECORDS`` of a batch."""
    for batch in batches:
        parts, held = [], 0
        for own, h, doc, pos, n, at in _records_of(batch, length):
            parts.append((h, _digests(own, at, at + n + length - 1), doc, pos, n))
            held += len(h)
            if held >= RECORDS:
                yield _contents(*map(np.concatenate, zip(*parts, strict=True)))
                parts, held = [], 0
        if parts:
            yield _contents(*map(np.concatenate, zip(*parts, strict=True)))
    release()


def records(keyed: DataFrame, length: int) -> DataFrame:
    """The records of (_key, text): h, digest c1 and c2 of the content, its first place of a batch, and the others as ``dups``."""
    return keyed.mapInArrow(lambda batches: record_batches(batches, length), "h long, c1 long, c2 long, doc long, pos long, n int, dups array<struct<doc:long,pos:long>>")


def anchors(keyed: DataFrame, length: int) -> DataFrame:
    """(h, n): the anchors of (_key, text) and in how many records, counted within some texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, *_ in _records_of(batch, length):
                own, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], ["h", "n"])
        release()

    return keyed.mapInArrow(run, "h long, n long")


def two_stage_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The starts of all suffixes of a byte array, sorted at least by their first ``depth`` bytes.

    Stage 1 sorts only the suffixes that are smaller than their successors, directly. Stage 2 scans the buckets of equal
    first bytes upwards: each suffix found puts its predecessor, if that is larger than it, at the next free place
    in front of the predecessor's bucket. The scan takes a bucket's stretch of known suffixes at a time; a run of one byte
    feeds its own bucket and takes a further stretch for each repeat.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    change = np.flatnonzero(text[1:] != text[:-1])  # a suffix is judged at the end of its run of equal bytes
    smaller = np.zeros(n, bool)
    if len(change):
        at = np.searchsorted(change, np.arange(n))
        inside = at < len(change)
        ends = change[at[inside]]
        smaller[np.flatnonzero(inside)] = text[ends] < text[ends + 1]
    padded = np.concatenate((text, np.zeros(depth, np.uint8)))
    prefixes = np.ndarray((n,), f"S{depth}", padded, 0, (1,))
    chosen = np.flatnonzero(smaller)
    chosen = chosen[np.argsort(prefixes[chosen], kind="stable")]
    sizes = np.bincount(text, minlength=256)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    small = np.bincount(text[chosen], minlength=256)
    tails = ends - small  # where the directly sorted suffixes of each bucket begin
    order = np.full(n, -1, np.int64)
    order[np.arange(len(chosen)) + np.repeat(tails - (np.cumsum(small) - small), small)] = chosen

    def induce(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            count = np.bincount(first, minlength=256)
            order[np.arange(len(before)) + np.repeat(heads - (np.cumsum(count) - count), count)] = before
            np.add(heads, count, out=heads)

    induce(np.array([n]))
    starts = ends - sizes
    for c in np.flatnonzero(sizes):
        done = starts[c]
        while done < heads[c]:
            done, stretch = heads[c], order[done : heads[c]]
            induce(stretch)
        induce(order[tails[c] : ends[c]])
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix in ``order`` with the one before it, up to ``depth`` bytes; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    eight = np.ndarray((len(text) + depth,), "<u8", padded, 0, (1,))
    alive = np.arange(1, len(order))
    for k in range(0, depth, 8):
        differ = eight[order[alive] + k] ^ eight[order[alive - 1] + k]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs is in the first byte that does
        same = np.where(differ == 0, 8, np.frexp(low.astype(np.float64))[1] - 1 >> 3)
        out[alive] += same
        alive = alive[differ == 0]
    ends = np.minimum(len(text) - order[1:], len(text) - order[:-1])
    out[1:] = np.minimum(np.minimum(out[1:], ends), depth)
    return out


def repeated_windows(doc: np.ndarray, pos: np.ndarray, n: np.ndarray, payload: list[bytes], length: int) -> np.ndarray:
    """For each window of each record in turn: whether an equal window starts earlier, by (doc, start).

    One suffix array over the records' bytes; neighbours with a common prefix of ``length`` bytes or more are equal windows.
    """
    sizes = np.array([len(p) for p in payload], np.int64)
    begin = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(payload), np.uint8)
    number = np.full(len(text), -1, np.int64)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    number[begin[row] + at] = np.arange(len(row))
    order = two_stage_suffix_array(text, length)
    order = order[number[order] >= 0]
    own = number[order]
    group = np.cumsum(common_prefixes(text, order, length) < length)
    by = np.lexsort((pos[row[own]] + at[own], doc[row[own]], group))
    later = np.zeros(len(order), bool)
    later[1:] = group[by][1:] == group[by][:-1]
    bad = np.zeros(len(row), bool)
    bad[own[by]] = later
    return bad


FETCHED = "g long, h long, c1 long, c2 long, doc long, pos long, skip int, n int, payload binary"


def _fetch(contents: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """The bytes of each content, under its anchor; of contents of hot anchors each window, under its own bytes.

    ``skip``: how many windows of the content come before the row's first.
    """
    fields = ["h", "c1", "c2", "pos", "n", "hot"]
    lists = contents.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    texts = shipped(keyed)
    rows = texts.join(lists, texts["_key"] == lists["doc"]).select("_key", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, wanted = batch.column(0).to_numpy(), batch.column(2)
            bounds = wanted.offsets.to_numpy().astype(np.int64)
            bounds -= bounds[0]
            cells = [x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten()]
            for i, j, data, offsets in received(batch.column(1)):
                h, c1, c2, pos, n, hot = (x[bounds[i] : bounds[j]] for x in cells)
                doc = np.repeat(keys[i:j], np.diff(bounds[i : j + 1]))
                start = pos + np.repeat(offsets[:-1], np.diff(bounds[i : j + 1]))
                per = np.where(hot, n, 1)
                at = np.repeat(np.arange(len(h)), per)
                skip = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per)
                count = np.where(hot, 1, n)[at]
                low = start[at] + skip
                payload = [data[a:b].tobytes() for a, b in zip(low.tolist(), (low + count + length - 1).tolist(), strict=True)]
                g = h[at]
                for k in np.flatnonzero(hot[at]).tolist():
                    g[k] = name(payload[k]) >> 1
                out = [pa.array(x) for x in (g, h[at], c1[at], c2[at], doc[at], pos[at], skip.astype(np.int32), count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*out, pa.array(payload, pa.binary())], [x.split()[0] for x in FETCHED.split(", ")])
        release()

    return rows.mapInArrow(run, FETCHED)


JUDGED = "h long, c1 long, c2 long, doc long, pos long, lead boolean, spans array<struct<b:long,e:long>>"


def judged(fetched: DataFrame, length: int, chunk: int = CHUNK) -> DataFrame:
    """Each content's first place and the spans there that earlier windows cover; one row of a content is its ``lead``.

    Suffix arrays are over whole groups g, as many as make ``chunk`` bytes.
    """

    def verdict(held: list[list]) -> pa.RecordBatch:
        h, c1, c2, doc, pos, skip, n = (np.array(x, np.int64) for x in held[1:8])
        bad = repeated_windows(doc, pos + skip, n, held[8], length)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        first, last = runs(bad, row)
        base = (pos + skip)[row[first]]
        spans = pa.StructArray.from_arrays([pa.array(base + at[first]), pa.array(base + at[last] + length)], ["b", "e"])
        ends = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=len(n))))).astype(np.int32)
        return pa.RecordBatch.from_arrays([*map(pa.array, (h, c1, c2, doc, pos, skip == 0)), pa.ListArray.from_arrays(pa.array(ends), spans)], [x.split()[0] for x in JUDGED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(9)]
        size = 0
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(9)]
            g = cols[0]
            bytes_ = np.concatenate(([0], np.cumsum([len(p) for p in cols[8]])))
            a = 0
            while a < len(g):
                b = min(len(g), max(a + 1, int(np.searchsorted(bytes_, bytes_[a] + max(0, chunk - size)))))
                while b < len(g) and g[b] == g[b - 1]:
                    b += 1
                if held[0] and size >= chunk and g[a] != held[0][-1]:
                    yield verdict(held)
                    held, size = [[] for _ in range(9)], 0
                for x, y in zip(held, cols, strict=True):
                    x += y[a:b]
                size += int(bytes_[b] - bytes_[a])
                a = b
        if held[0]:
            yield verdict(held)
        release()

    return fetched.repartition("g").sortWithinPartitions("g").mapInArrow(run, JUDGED)


def removal_spans(keyed: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """Spans (doc, b, e), in bytes, that an equal ``length``-byte string starting earlier covers; spans may overlap.

    An anchor with over ``hot`` contents would make one large suffix array: its windows are filed one by one under a hash of
    their own bytes, so that equal windows still meet. All rows of one window meet in one task, whatever their number.
    Windows of equal contents (anchor, length and digest of all bytes) are told by the digest; see ``judged`` for the others.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    found = records(keyed, length)
    often = anchors(keyed, length).groupBy("h").agg(F.sum("n").alias("c")).where("c > 1").select("h")
    kept = materialise(found.join(often, "h"))
    contents = materialise(kept.groupBy("h", "c1", "c2", "n").agg(F.min(F.struct("doc", "pos")).alias("first")))
    many = contents.groupBy("h").count().where(F.col("count") > hot).select("h", F.lit(True).alias("many"))
    wanted = contents.join(many, "h", "left").select("h", "c1", "c2", "first.*", "n", F.coalesce("many", F.lit(False)).alias("hot"))
    done = materialise(judged(_fetch(wanted, keyed, length), length))
    lead = done.where("lead").select("h", "c1", "c2", F.col("doc").alias("d"), F.col("pos").alias("p"))
    span = lambda df: df.select("doc", F.col("pos").alias("b"), (F.col("pos") + F.col("n") + length - 1).alias("e"))
    copies = kept.join(lead, ["h", "c1", "c2"])
    forget(contents)
    out = done.select("doc", F.explode("spans").alias("s")).select("doc", "s.b", "s.e")
    out = out.union(span(copies.where("doc <> d or pos <> p")))
    return out.union(span(copies.where("dups is not null").select("n", F.explode("dups").alias("s")).select("n", "s.doc", "s.pos")))


def _applied(rows: DataFrame, whole_characters: bool) -> DataFrame:
    """Cut the spans out. whole_characters: spans shrink to whole code points, and the text comes back as a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, j, data, offsets in ((b, *part) for b in batches for part in received(b.column(1))):
            out: list[tuple] = []
            for k, spans in enumerate(batch.column(2)[i:j].to_pylist()):
                whole = data[offsets[k] : offsets[k + 1]].tobytes()
                runs = merged([(s["b"], s["e"]) for s in spans or ()])
                if whole_characters:
                    inner = []
                    for b, e in runs:
                        while b < e and whole[b] & 0xC0 == 0x80:
                            b += 1
                        while e > b and e < len(whole) and whole[e] & 0xC0 == 0x80:
                            e -= 1
                        inner.append((b, e))
                    runs = [r for r in inner if r[0] < r[1]]
                edges = [0, *[x for r in runs for x in r], len(whole)]
                kept = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if runs else whole
                out.append((len(whole), len(whole) - len(kept), len(runs), kept.decode() if whole_characters else hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], ["_key", "n_bytes", "n_removed", "n_spans", "kept"])
        release()

    return rows.mapInArrow(run, "_key long, n_bytes long, n_removed long, n_spans long, kept string")


def dedup(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """Of every text of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, null ones empty; each byte is removed that lies in a string of ``length`` bytes which also starts
    earlier (smaller doc_id, or same document and earlier start), judged on the input. Texts shorter than ``length`` stay
    whole; very long ones are worked on in pieces that overlap by a window. Rows that repeat a doc_id count as different
    documents, ordered by text; a null doc_id is the smallest. Other columns aren't looked at; no rows give no rows.
    """
    keyed, originals = unique_keys(docs.select("doc_id", "text"))
    pure = keyed.select("_key", "text")
    out = _applied(with_spans(pure, removal_spans(pure, length, hot)), False).withColumnRenamed("kept", "kept_sha256")
    return originals(out).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = 100, hot: int = HOT) -> DataFrame:
    """``docs`` with repeated strings cut out of text (whole code points only) and n_chars set anew; every row stays.

    A null text stays null. Other columns stay as they are, whatever their types and names.
    """
    keyed, originals = unique_keys(packed(docs, "text").withColumn("_null", F.col("text").isNull()))
    pure = keyed.select("_key", "text")
    out = _applied(with_spans(pure, removal_spans(pure, length, hot)), True).select("_key", F.col("kept").alias("_kept"))
    new = F.when(F.col("_null"), F.lit(None).cast("string")).otherwise(F.col("_kept"))
    set_anew = {"text": new, "n_chars": F.char_length(new).cast("long")}
    return originals(out).select(*[set_anew[c].alias(c) if c in set_anew else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
