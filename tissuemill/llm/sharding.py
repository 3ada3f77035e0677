"""Sharding through fixed virtual slots, in DataFrame operations only.

A record's slot comes from a digest of the record alone and never changes; there are some thousands of slots, however many
shards and records. A small table says which shard holds which slot. It is stored in versions, and a rebalancing writes a
new version that moves some slots: records are looked up in the table, never dealt out anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tissuemill.functions.storage import materialise, shared_dir

#: Virtual slots: a multiple of many numbers of shards.
SLOTS = 8640
#: Slots that a map may have: it is broadcast, and edited as one row.
MOST_SLOTS = 1 << 16
#: Bytes of a record beside its text.
OVERHEAD = 8
#: Equal records that are written out at once.
RUN = 1 << 20


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with size, text_crc32 and virtual_slot (columns of these names are replaced).

    size: bytes of the text in UTF-8 (null: none) and 8. The slot is the md5 digest of doc_id, size and text_crc32, modulo ``slots``: rows of one
    doc_id (or without) are spread as long as their texts differ.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    row = docs.drop("size", "text_crc32", "virtual_slot").withColumns({"size": F.octet_length(text).cast("long") + OVERHEAD, "text_crc32": F.crc32(text)})
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    return row.withColumn("virtual_slot", (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int"))


def slot_sizes(keyed: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows) of sized rows, each ``n`` times where they have such a column."""
    n = F.col("n") if "n" in keyed.columns else F.lit(1).cast("long")
    return keyed.groupBy("virtual_slot").agg(F.sum(F.col("size") * n).alias("bytes"), F.sum(n).alias("rows"))


def even_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, shard): the first version of a map, slots dealt in turn."""
    if not 0 < shards <= slots <= MOST_SLOTS:
        raise ValueError(f"as many slots as shards, or more, and at most {MOST_SLOTS}")
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard"))


def rebalanced(mapping: DataFrame, sizes: DataFrame, shards: int, into: int | None = None) -> DataFrame:
    """``mapping`` edited so that each of ``shards`` holds about the same bytes; with ``into`` slots move to that shard only.

    Each shard keeps its slots from the largest on up to its equal share, and empty ones; the slots beyond that move. The largest goes first, to
    the shard that is emptiest then (ties: smaller numbers). No shard ends with more than its share and one slot of those that moved.
    """
    have = mapping.join(F.broadcast(sizes), "virtual_slot", "left").select("virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))
    large_first = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("bytes").over(Window.partitionBy())
    judged = have.withColumn("stays", (F.col("bytes") == 0) | (F.sum("bytes").over(large_first) * shards <= share))
    stay, move = judged.where("stays"), judged.where("not stays")
    if into is not None:
        return stay.select("virtual_slot", "shard").union(move.select("virtual_slot", F.lit(into).cast("int")))
    spark = mapping.sparkSession
    loads = spark.range(shards).select(F.col("id").cast("int").alias("shard")).join(stay.groupBy("shard").agg(F.sum("bytes").alias("bytes")), "shard", "left")
    both = loads.select(F.struct(F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), "shard").alias("load"), F.lit(None).alias("slot"))
    both = both.union(move.select(F.lit(None), F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))
    one = both.agg(F.array_sort(F.collect_list("load")).alias("loads"), F.array_sort(F.collect_list("slot")).alias("pool"))

    def placed(state: Column, slot: Column) -> Column:
        emptiest = F.get(state["loads"], F.lit(0))
        rest = F.slice(state["loads"], 2, shards)
        grown = F.struct((emptiest["bytes"] - slot["less"]).alias("bytes"), emptiest["shard"].alias("shard"))
        return F.struct(F.array_sort(F.concat(rest, F.array(grown))).alias("loads"), F.concat(state["to"], F.array(emptiest["shard"])).alias("to"))

    begin = F.struct(F.col("loads"), F.array().cast("array<int>").alias("to"))
    plan = one.select("pool", F.aggregate("pool", begin, placed, lambda s: s["to"]).alias("to"))
    moved = plan.select(F.explode(F.arrays_zip("pool", "to")).alias("m")).select("m.pool.virtual_slot", F.col("m.to").alias("shard"))
    return stay.select("virtual_slot", "shard").union(moved)


def grown(mapping: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """``mapping`` of ``shards`` shards edited for one more, which takes slots only into itself."""
    return rebalanced(mapping, sizes, shards + 1, into=shards)


def write_map(mapping: DataFrame, path: str, version: int) -> None:
    """Store a version; one that exists is an error, so that of two editors one is told."""
    mapping.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard, version) of a stored version, or of the last."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    return stored.where(F.col("version") == (version if version is not None else stored.agg(F.max("version")).first()[0]))


def assigned(docs: DataFrame, mapping: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with size, text_crc32, virtual_slot and shard; no row is shuffled. Columns of these names are replaced."""
    return sized(docs.drop("shard"), slots).join(F.broadcast(mapping.select("virtual_slot", "shard")), "virtual_slot")


def write_shards(docs: DataFrame, mapping: DataFrame, path: str, files: int = 16, slots: int = SLOTS) -> None:
    """Write ``docs`` as a folder for each shard, each in some ``files`` files by slots; docs' own columns and virtual_slot."""
    rows = assigned(docs, mapping, slots).drop("size", "text_crc32")
    rows.repartition("shard", F.col("virtual_slot") % files).write.mode("error").partitionBy("shard").parquet(path)


def shard(docs: DataFrame, shards: int = 24, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Of every row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    The law is ``bytes``: shards have nearly equal sums of size. slot: the row's place in its shard, without gaps from 0, by
    virtual slot, doc_id (nulls first), size and checksum. grown_shard is null: under this law the bytes, and not the doc_id
    alone, decide what a further shard takes (see ``grown``). Both versions of the map, 0 (even) and 1 (rebalanced), are stored in ``path``, or
    else in a new shared folder; the rows are looked up in the last stored one.

    Null texts have no bytes, null doc_ids are good; an empty table gives no rows. Equal rows (doc_id, size and checksum) can't
    be told apart and share a virtual slot; they are counted before any shuffle, one row for each and its number, and written out again
    at the end. Texts are read once and only for their length and checksum, however long. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = sized(docs.select("doc_id", "text"), slots).groupBy("virtual_slot", "doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    keyed = materialise(rows)
    sizes, path = slot_sizes(keyed), path or shared_dir(spark)
    write_map(even_map(spark, shards, slots), path, 0)
    write_map(rebalanced(read_map(spark, path, 0), sizes, shards), path, 1)
    mapping = read_map(spark, path)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    begins = mapping.join(F.broadcast(sizes), "virtual_slot").withColumn("begin", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    own = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("nth", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(begins.select("virtual_slot", "shard", "version", "begin")), "virtual_slot")
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))))
    each = runs.withColumn("k", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)))
    slot = F.col("begin") + F.col("nth") + F.col("k")
    return each.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"),
    )


#: The same shards of ``documents`` in DuckDB.
ORACLE = f"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS c FROM range(256) t(n)
  )
), sized AS MATERIALIZED (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + {OVERHEAD} AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, steps
), keyed AS MATERIALIZED (
  SELECT *, (('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32)[1:8])::BIGINT % {SLOTS})::INTEGER AS virtual_slot FROM sized
), slots AS MATERIALIZED (
  SELECT v::INTEGER AS virtual_slot, (v % 24)::INTEGER AS shard, coalesce(bytes, 0)::BIGINT AS bytes, coalesce(n, 0) AS n
  FROM range({SLOTS}) t(v) LEFT JOIN (SELECT virtual_slot AS v, sum(size) AS bytes, count(*) AS n FROM keyed GROUP BY v) USING (v)
), judged AS MATERIALIZED (
  SELECT *, bytes = 0 OR sum(bytes) OVER (PARTITION BY shard ORDER BY bytes DESC, virtual_slot ROWS UNBOUNDED PRECEDING) * 24 <= sum(bytes) OVER () AS stays FROM slots
), pool AS MATERIALIZED (SELECT row_number() OVER (ORDER BY bytes DESC, virtual_slot) AS i, virtual_slot, bytes FROM judged WHERE NOT stays),
fold(i, loads, target) AS (
  SELECT 0::BIGINT, list(coalesce(b, 0)::BIGINT ORDER BY s), 0::BIGINT FROM range(24) t(s) LEFT JOIN (SELECT shard AS s, sum(bytes) AS b FROM judged WHERE stays GROUP BY shard) USING (s)
  UNION ALL
  SELECT f.i + 1, list_transform(loads, lambda x, k: x + CASE WHEN k = list_position(loads, list_min(loads)) THEN bytes ELSE 0 END), list_position(loads, list_min(loads))::BIGINT - 1
  FROM fold f JOIN pool ON pool.i = f.i + 1
), mapping AS (
  SELECT virtual_slot, shard FROM judged WHERE stays UNION ALL SELECT virtual_slot, target::INTEGER FROM pool JOIN fold USING (i)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  NULL::INTEGER AS grown_shard, virtual_slot, 1::INTEGER AS map_version
FROM keyed JOIN mapping USING (virtual_slot)
"""
