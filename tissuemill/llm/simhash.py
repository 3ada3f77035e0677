"""SimHash near-duplicates: pigeonhole blocks, joined on blocks, verified by Hamming distance.

Two uses: ``near_duplicates`` links 64-bit fingerprints that differ in a few bits. ``keep_one_of_each`` drops near copies by
shingle sets; a similarity of 0.8 means that some 15 % of fingerprint bits differ, ten of 64, which no blocks of 64 bits can
serve. Its fingerprints are 3072 bits wide, in 128 blocks of 24: documents that differ in fewer than 128 bits share a block
for certain (similarity 0.95 or so), others with the chance that ``Wide`` states. Pairs from the blocks are verified by their
Hamming distance and then by the shingle sets themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.storage import settled
from tissuemill.llm.common import as_int64, groups_of_rows, lighter, materialise, packed, release, text_buffer, unique_keys
from tissuemill.llm.components import components

#: For each byte value, its eight bits in eight byte lanes; up to 255 of them add up without carry.
LANES = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], np.uint64)
#: Shares of the shingle hashes by which rows are compared before they are paired; more shares rule out more pairs.
SHARES = 64


def shingle_hashes(text: bytes, width: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each word shingle of a text, repeats included; fewer words than ``width``: the whole sequence."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -width])).tolist()
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]


def fold(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The 64-bit fingerprint of each row from its run of hashes: a bit is set where over half of them have it."""
    out = np.zeros(len(counts), np.uint64)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    own = counts[rows]
    pieces = -(-own // 255)
    first = np.concatenate(([0], np.cumsum(pieces)))
    base = np.repeat(np.concatenate(([0], np.cumsum(own)[:-1])), pieces)
    cuts = base + 255 * (np.arange(first[-1]) - np.repeat(first[:-1], pieces))
    lanes = np.add.reduceat(LANES[hashes.view(np.uint8).reshape(-1, 8)], cuts, axis=0)
    bits = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64).astype(np.int64), first[:-1], axis=0)
    out[rows] = np.packbits(2 * bits > own[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``; null and wordless texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            parts = []
            for i, j in groups_of_rows(offsets):
                each = [shingle_hashes(data[a:b].tobytes(), width, seed) for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]
                counts = np.array([len(x) for x in each], np.int64)
                parts.append(fold(np.array([h for x in each for h in x], np.uint64), counts))
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), as_int64(fp)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def links(distinct: DataFrame, max_bits: int = 2, blocks: int = 4, block_rows: int = 64) -> DataFrame:
    """Edges (u, v) that connect the fingerprints of ``distinct`` (column fp) differing in ``max_bits`` bits or fewer.

    The 64 bits are cut into ``blocks``; fingerprints that differ in k bits agree in at least blocks-k of them, so each is
    filed under every choice of blocks-k blocks and joined there; the Hamming distance is verified in the join.
    A block of over ``block_rows`` fingerprints isn't paired off: its members (max_bits 2) are filed under themselves
    and their 64 one-bit neighbours. Two of them share such a key exactly if they differ in two bits or fewer, a
    key has at most 65 members, and each is linked to the least, so the same fingerprints stay connected without all pairs.
    """
    if not 0 < max_bits < blocks:
        raise ValueError("blocks must be more than max_bits")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << cuts[b + 1]) - (1 << cuts[b])) for b in keep) for keep in combinations(range(blocks), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    filed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("slot", "block"))
    sizes = filed.groupBy("slot", "block").count().where("count > 1")
    filed = materialise(filed.join(sizes, ["slot", "block"]))
    small, large = filed.where(F.col("count") <= block_rows), filed.where(F.col("count") > block_rows)
    a, b = small.select("slot", "block", F.col("fp").alias("u")), small.select("slot", "block", F.col("fp").alias("v"))
    near = a.join(b, (a["slot"] == b["slot"]) & (a["block"] == b["block"]) & (a["u"] > b["v"]) & (F.bit_count(a["u"].bitwiseXOR(b["v"])) <= max_bits)).select("u", "v")
    if large.isEmpty():
        return near
    if max_bits != 2:
        return near.union(hot_links(large.select(F.col("fp").alias("id"), "slot", F.col("block").alias("key")), lambda pairs: pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)))
    keys = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(x)) for x in [*[1 << k for k in range(63)], -(1 << 63)]]]
    star = large.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("key"))
    star = star.select(F.col("fp").alias("u"), F.min("fp").over(Window.partitionBy("key")).alias("v")).where("u > v")
    return near.union(star)


def hot_links(large: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (u, v) that connect the members of large keys, (id, slot, key), as all verified pairs of a key would.

    Members are compared with the first of their key. What is linked to one same member needs no more comparison; of the
    others each is compared with all of the key that aren't known to be linked to it. ``verify`` keeps the pairs that hold.
    """
    first = large.groupBy("slot", "key").agg(F.min("id").alias("pivot"))
    to_first = large.join(first, ["slot", "key"]).where("id > pivot").select(F.col("id").alias("u"), F.col("pivot").alias("v"))
    star = materialise(verify(materialise(to_first.distinct())))
    to = star.groupBy("u").agg(F.min("v").alias("to"))
    named = materialise(large.join(to, large["id"] == to["u"], "left").select("slot", "key", "id", F.coalesce("to", "id").alias("to")))
    each = named.groupBy("slot", "key", "to").count()
    most = each.groupBy("slot", "key").agg(F.max_by("to", F.struct("count", "to")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    named = named.join(most, ["slot", "key"])
    odd = named.where("to <> top").select("slot", "key", F.col("id").alias("u"), F.col("to").alias("tu"))
    rest = odd.join(named.select("slot", "key", F.col("id").alias("v"), F.col("to").alias("tv"), "top"), ["slot", "key"]).where("tu <> tv and (tv = top or u > v)")
    more = rest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return star.union(verify(materialise(more.distinct())))


def near_duplicates(docs: DataFrame, max_bits: int = 2, blocks: int = 4, width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    The fingerprint is of the lower-cased (A-Z) word shingles, as 16 hex digits; component_id is the smallest doc_id that
    links of ``max_bits`` differing bits or fewer reach. Copies share a fingerprint, so work is on distinct ones. Null or
    wordless texts have fingerprint zero and are linked like any other; rows that repeat a doc_id keep a row each; a null
    doc_id stays null and never is a component_id unless all of the component's are null. An empty table gives no rows.
    """
    marks = materialise(fingerprints(docs, width))
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(distinct.select("fp"), max_bits, blocks))
    named = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = materialise(named)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return (
        marks.join(named.join(least, "component").select("fp", "component_id"), "fp")
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    )


@dataclass(frozen=True)
class Wide:
    """Fingerprints of ``blocks`` x ``bits`` bits for near copies.

    A pair of which a share p of the bits differ has an equal block with probability 1 - (1 - (1 - p) ** bits) ** blocks. With
    128 blocks of 24 bits that is 0.92 at a similarity of 0.8 (p = 0.15), 0.995 at 0.85, 0.9999 at 0.9.
    Unrelated documents share a given block with probability 2 ** -bits.
    """

    bits: int = 24
    blocks: int = 128

    @property
    def words(self) -> int:
        return self.bits * self.blocks // 64

    @property
    def most(self) -> int:
        """Differing bits up to which a pair goes on to the comparison of sets: a quarter; unrelated ones differ in half."""
        return self.bits * self.blocks // 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted hashes of each row's distinct shingles."""
    ends = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    return [np.unique(np.array(shingle_hashes(data[a:b].tobytes(), width), np.uint64)) for a, b in ends]


def wide_fingerprints(sets: list[np.ndarray], wide: Wide) -> np.ndarray:
    """Rows x words: SimHash over as many independent hashes of each distinct shingle as there are 64-bit words."""
    flat, counts = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    out = np.empty((len(sets), wide.words), np.uint64)
    for k in range(wide.words):
        h = (flat ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        out[:, k] = fold(h, counts)
    return out


def blocks_of(prints: np.ndarray, wide: Wide) -> np.ndarray:
    """Rows x blocks: the fingerprints cut into blocks."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little").reshape(len(prints), wide.blocks, wide.bits)
    room = np.zeros((len(prints), wide.blocks, 32), np.uint8)
    room[:, :, : wide.bits] = bits
    return np.packbits(room, axis=2, bitorder="little").view(np.uint32)[:, :, 0].astype(np.int32)


def _lists(values: np.ndarray, held: np.ndarray) -> pa.Array:
    """A list for each row: the next row of ``values`` where ``held``, else an empty one."""
    ends = np.concatenate(([0], np.cumsum(np.where(held, values.shape[1], 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def wide_marks(docs: DataFrame, width: int, wide: Wide) -> DataFrame:
    """(id, low, high, print, blocks) of each row of (id, text): the 128-bit name of its shingle set, fingerprint and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups_of_rows(offsets):
                sets = shingle_sets(data, offsets[i : j + 1], width)
                names = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in sets], np.uint64).reshape(-1, 2)
                held = np.array([len(s) > 0 for s in sets])
                prints = wide_fingerprints([s for s in sets if len(s)], wide) if held.any() else np.zeros((0, wide.words), np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], as_int64(names[:, 1]), as_int64(names[:, 0]), _lists(prints.view(np.int64), held), _lists(blocks_of(prints, wide), held)], ["id", "low", "high", "print", "blocks"])
        release()

    return docs.mapInArrow(run, "id long, low long, high long, print array<long>, blocks array<int>")


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """(id, set) of each row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups_of_rows(offsets):
                sets = shingle_sets(data, offsets[i : j + 1], width)
                ends = pa.array(np.cumsum([0, *[len(s) for s in sets]], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(ends, as_int64(np.concatenate(sets)))], ["id", "set"])
        release()

    return docs.mapInArrow(run, "id long, set array<long>")


def _close(pairs: DataFrame, prints: DataFrame, most: int) -> DataFrame:
    """The pairs whose fingerprints differ in ``most`` bits or fewer."""
    both = pairs.join(prints.toDF("u", "a"), "u").join(prints.toDF("v", "b"), "v")
    apart = F.aggregate(F.zip_with("a", "b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
    return both.where(apart <= most).select("u", "v")


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have a Jaccard similarity of ``percent`` / 100 or more, in whole numbers."""
    both = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")
    small, large = F.least(F.size("a"), F.size("b")), F.greatest(F.size("a"), F.size("b"))
    both = both.where(100 * small >= percent * large)
    s, n = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    return both.where((100 + percent) * s >= percent * n).select("u", "v")


def near_links(texts: DataFrame, marks: DataFrame, percent: int, width: int, wide: Wide, company: int = 64, guides: int = 8) -> DataFrame:
    """Edges (u, v) that connect the rows of ``marks`` which share a block and whose shingle sets are similar.

    A large group of near copies shares blocks in many ways, large and small, so pairing off would give about all its pairs.
    First the rows that meet others over ``company`` times in their blocks are compared with up to ``guides`` rows each, those
    that stand for most of their blocks (a block's is the one with the most company, in a group the text that the others come
    from). Components of these links are known to be connected; pairs are made only between different ones of a block,
    and only where ``_possible`` can't rule them out, so no link between components is lost.
    """
    filed = marks.select("id", F.posexplode("blocks").alias("slot", "key"))
    shared = materialise(filed.groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1"))
    filed = materialise(filed.join(shared, ["slot", "key"]))
    met = materialise(filed.groupBy("id").agg(F.sum(F.col("n") - 1).alias("w")))
    prints = materialise(marks.join(met, "id", "left_semi").select("id", "print"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialise(_close(materialise(pairs), prints, wide.most))
        both = materialise(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct())
        sets = materialise(sets_of(texts.join(lighter(both), "id", "left_semi").select("id", "text"), width))  # ids go to the texts, where they can
        return materialise(_alike(pairs, sets, percent))

    named = filed.select("slot", "key", "id", F.col("id").alias("part"), F.lit(None).cast("int").alias("size"), F.lit(None).cast("array<int>").alias("common"))
    busy = met.where(F.col("w") > company)
    if busy.isEmpty():
        return verify(across(named, percent))
    star = verify(guided(filed, busy, guides))
    counts = own_shingles(sets_of(texts.join(lighter(materialise(busy.select("id"))), "id", "left_semi").select("id", "text"), width))
    named = named.drop("part", "size", "common").join(components(star).toDF("id", "part"), "id", "left").join(counts, "id", "left")
    return star.union(verify(across(named.withColumn("part", F.coalesce("part", "id")), percent)))


def own_shingles(sets: DataFrame) -> DataFrame:
    """(id, size, common) of each row of (id, set): how many shingles it has, and how many that others have too, by ``SHARES`` shares of the hashes."""
    sets = materialise(sets)
    once = sets.select("id", F.explode("set").alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    own = once.groupBy("id").agg(F.collect_list("h").alias("own"))  # no longer than the row's set

    def by_share(lists: pa.Array) -> np.ndarray:
        rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        return np.bincount(rows * SHARES + lists.flatten().to_numpy() % SHARES, minlength=len(lists) * SHARES).reshape(-1, SHARES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = by_share(batch.column(1)) - by_share(batch.column(2))
            size = pc.list_value_length(batch.column(1)).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, _lists(common.astype(np.int32), np.ones(len(size), bool))], ["id", "size", "common"])
        release()

    both = sets.join(own, "id", "left").select("id", "set", F.coalesce("own", F.array().cast("array<long>")).alias("own"))
    return materialise(both.mapInArrow(run, "id long, size int, common array<int>"))


def _possible(percent: int) -> Column:
    """Whether rows of ``size`` and ``size_v`` shingles can have the similarity: in each share of the hashes they have at most
    the lesser of their numbers of common shingles in common.

    Rows that meet few others have no counts and are let through: what they have in common with others isn't known.
    """
    most = F.aggregate(F.zip_with("common", "common_v", lambda a, b: F.least(a, b)), F.lit(0), lambda n, k: n + k)
    return F.col("common").isNull() | F.col("common_v").isNull() | ((100 + percent) * most >= percent * (F.col("size") + F.col("size_v")))


def guided(filed: DataFrame, busy: DataFrame, guides: int) -> DataFrame:
    """Pairs (u, v): each row of ``busy``, (id, w), with up to ``guides`` of those that stand for most of its blocks."""
    large = materialise(filed.join(busy, "id").select("slot", "key", "id", "w"))
    lead = large.groupBy("slot", "key").agg(F.max(F.struct("w", "id")).alias("lead"))
    asked = large.join(lead, ["slot", "key"]).select(F.col("id").alias("u"), F.col("lead.id").alias("v"), F.col("lead.w").alias("w")).where("u <> v")
    asked = asked.groupBy("u", "v").agg(F.count("*").alias("common"), F.first("w").alias("w"))
    nth = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("common"), F.desc("w"), F.desc("v")))
    best = asked.withColumn("nth", nth).where(F.col("nth") <= guides)
    return best.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def across(named: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of rows of different parts that share a block, from (slot, key, id, part, size, common)."""
    each = named.groupBy("slot", "key", "part").count()
    most = each.groupBy("slot", "key").agg(F.max_by("part", F.struct("count", "part")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1").drop("kinds")
    named = materialise(named.join(most, ["slot", "key"]))
    odd = named.where("part <> top").select("slot", "key", F.col("id").alias("u"), F.col("part").alias("tu"), "size", "common")
    whole = named.select("slot", "key", F.col("id").alias("v"), F.col("part").alias("tv"), "top", F.col("size").alias("size_v"), F.col("common").alias("common_v"))
    met = (odd["slot"] == whole["slot"]) & (odd["key"] == whole["key"]) & F.expr("tu <> tv and (tv = top or u > v)") & _possible(percent)
    return odd.join(whole, met).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def keep_one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, wide: Wide = Wide(), company: int = 64) -> DataFrame:
    """The rows of ``docs`` without near copies: of the rows that links connect, the one with the smallest doc_id stays.

    Rows are linked whose sets of ``width``-word shingles (A-Z lower-cased; a text of fewer words is one shingle) have a Jaccard
    similarity of ``percent`` / 100 or more and whose fingerprints share a block. Rows of equal sets are settled by name (128
    bits), and rows without a word are copies of each other. Null texts have no words; very long texts are taken whole. All
    columns stay as they are. Of rows that repeat a doc_id, the one with the least text counts as first; a null doc_id counts
    as the smallest. No rows give no rows.
    """
    keyed, _ = unique_keys(packed(docs))
    texts = keyed.select(F.col("_key").alias("id"), "text")

    def dropped() -> DataFrame:
        found = materialise(wide_marks(texts, width, wide))
        least = found.groupBy("low", "high").agg(F.min("id").alias("least"))
        first = found.join(least.select(F.col("least").alias("id")), "id", "left_semi")
        parts = components(near_links(texts, first, percent, width, wide, company))
        copies = found.select("id", "low", "high").join(least, ["low", "high"]).where("id <> least").select("id")
        return copies.union(parts.where("node <> component").select("node")).toDF("_key")

    drop = settled(docs.sparkSession, dropped)  # of the stage's tables only the ids that go are left
    return keyed.join(drop, "_key", "left_anti").select("_row.*")
