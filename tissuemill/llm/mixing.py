"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Every source is cut into blocks. Block j (from 0) of a source with weight w is released at slot floor(j/w) and due by slot
ceil((j+1)/w); each slot takes, of the blocks released, the one due first. With weights that add up to one no slot is
idle and no deadline is missed, so that after any number of slots each source is less than one block from its share.
Weights are whole parts of a cycle, and the schedule repeats with the cycle: it is made for one cycle of as many slots as
there are parts, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.scalar import let

#: Sources that may be mixed: the schedule of one cycle is a single row.
MOST_SOURCES = 1000
NO_SOURCE = "(none)"


def _sources(docs: DataFrame, weights: Mapping[str, int] | None, parts: int) -> tuple[DataFrame, DataFrame]:
    """Rows by source and leading hash digits, and the sources with their whole weights."""
    counts = docs.groupBy("_source", "_salt").agg(F.count("*").alias("n"))
    totals = counts.groupBy("_source").agg(F.sum("n").alias("rows"))
    if weights is None:
        share = F.sqrt("rows") / F.sum(F.sqrt("rows")).over(Window.partitionBy())
        return counts, totals.withColumn("parts", F.greatest(F.lit(1), F.floor(share * parts + 0.5)).cast("long"))
    chosen = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
    return counts, totals.withColumn("parts", F.coalesce(chosen[F.col("_source")] if weights else F.lit(None), F.lit(1)).cast("long"))


def schedule(sources: DataFrame) -> DataFrame:
    """(_source, nth, at): the slot of each block of one cycle, from ``sources`` (_source, parts).

    Earliest deadline first, ties to the source that is first by name.
    """
    one = sources.agg(F.array_sort(F.collect_list(F.struct("_source", "parts"))).alias("s"), F.sum("parts").alias("slots"))
    one = one.where("size(s) > 0").withColumn("s", F.when(F.size("s") > MOST_SOURCES, F.raise_error(F.lit(f"more than {MOST_SOURCES} sources"))).otherwise(F.col("s")))

    def due(z: Column, x: Column, i: Column, done: Column, t: Column) -> Column:
        n, w = F.get(done, i), x["parts"]
        released = F.floor(n * z["slots"] / w) <= t
        return F.when((n < w) & released, F.struct(F.ceil((n + 1) * z["slots"] / w).alias("due"), i.alias("i")))

    def slot(z: Column, state: Column, t: Column) -> Column:
        first = F.array_min(F.transform(z["s"], lambda x, i: due(z, x, i, state["done"], t)))["i"]
        taken = F.struct(first.alias("i"), F.get(state["done"], first).alias("nth"), t.alias("at"))
        return F.struct(F.transform(state["done"], lambda n, i: F.when(i == first, n + 1).otherwise(n)).alias("done"), F.concat(state["plan"], F.array(taken)).alias("plan"))

    kind = "array<struct<i:int,nth:long,at:long>>"

    def stretch(z: Column, state: Column, low: Column) -> Column:
        """The slots from ``low`` on, as many as a stretch has: made apart, so that a slot copies a stretch and not all before."""
        times = F.sequence(low, F.least(low + z["wide"], z["slots"]) - 1)
        made = F.aggregate(times, F.struct(state["done"].alias("done"), F.array().cast(kind).alias("plan")), lambda x, t: slot(z, x, t))
        return F.struct(made["done"].alias("done"), F.concat(state["plan"], F.array(made["plan"])).alias("plan"))

    def cycle(z: Column) -> Column:
        start = F.struct(F.transform(z["s"], lambda x: F.lit(0).cast("long")).alias("done"), F.array().cast(f"array<{kind}>").alias("plan"))
        lows = F.sequence(F.lit(0).cast("long"), z["slots"] - 1, z["wide"])
        return F.flatten(F.aggregate(lows, start, lambda state, low: stretch(z, state, low), lambda x: x["plan"]))

    plan = one.select("s", F.explode(let(F.struct("s", "slots", F.ceil(F.sqrt("slots")).cast("long").alias("wide")), cycle)).alias("p"))
    return plan.select(F.get(F.col("s"), F.col("p.i"))["_source"].alias("_source"), "p.nth", "p.at")


def mix(docs: DataFrame, weights: Mapping[str, int] | None = None, block_rows: int = 64, parts: int = 1000) -> DataFrame:
    """``docs`` with mix_block, mix_slot, mix_position and mix_balanced; no row goes.

    ``weights``: whole target weights by source, 1 for others. Without them a source weighs the root of its rows, rounded to
    parts of about ``parts``, one at least. In a source, rows come in the order of md5(doc_id), ties by doc_id, and are cut
    into blocks of ``block_rows``; mix_position orders the mixture: mix_slot * block_rows + place in the block. A source
    that has run out leaves its slots empty; mix_balanced tells the rows of slots before any source lacks a full block.
    Null sources are one source, ``(none)``. Rows that repeat a doc_id stand in any order among themselves. Columns of
    ``docs`` with a name of these are replaced.

    A source that holds most rows is numbered in 4096 parts by leading hash digits: counts are pre-aggregated, their running
    sums give each part its start, and no window holds more than a part.
    """
    names = ["mix_block", "mix_slot", "mix_position", "mix_balanced"]
    docs = docs.drop(*names)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # apart from names in here
    source, digest = F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(row.alias("_row"), "doc_id", source.alias("_source"), digest.alias("_hash")).withColumn("_salt", F.substring("_hash", 1, 3))
    counts, sources = _sources(keyed, weights, parts)
    plan = schedule(sources.select("_source", "parts"))
    slots = F.sum("parts").over(Window.partitionBy())
    sized = sources.withColumn("slots", slots).withColumn("full", F.floor(F.col("rows") / block_rows))
    short = sized.join(plan, (sized["_source"] == plan["_source"]) & (F.col("full") % F.col("parts") == F.col("nth"))).select(sized["_source"], "parts", "slots", (F.floor(F.col("full") / F.col("parts")) * F.col("slots") + F.col("at")).alias("short"))
    table = short.withColumn("until", F.min("short").over(Window.partitionBy())).select("_source", "parts", "slots", "until")
    before = F.sum("n").over(Window.partitionBy("_source").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("_source", "_salt", F.coalesce(before, F.lit(0)).alias("_begin")).join(table, "_source")
    place = F.row_number().over(Window.partitionBy("_source", "_salt").orderBy("_hash", "doc_id")) - 1
    ranked = keyed.withColumn("_place", place).join(begins, ["_source", "_salt"])
    ranked = ranked.withColumn("_nth", F.col("_begin") + F.col("_place")).withColumn("mix_block", F.floor(F.col("_nth") / block_rows))
    ranked = ranked.withColumn("_turn", F.col("mix_block") % F.col("parts"))
    ranked = ranked.join(plan.select(F.col("_source").alias("_s"), "nth", "at"), (F.col("_source") == F.col("_s")) & (F.col("_turn") == F.col("nth")))
    slot = F.floor(F.col("mix_block") / F.col("parts")) * F.col("slots") + F.col("at")
    out = ranked.withColumn("mix_slot", slot).withColumns({"mix_position": F.col("mix_slot") * block_rows + F.col("_nth") % block_rows, "mix_balanced": F.col("mix_slot") < F.col("until")})
    return out.select("_row.*", *names)


#: The same mixture of ``documents`` in DuckDB.
ORACLE = """
WITH RECURSIVE keyed AS (
  SELECT doc_id, source, coalesce(source, '(none)') AS s, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), totals AS (SELECT s, count(*) AS n FROM keyed GROUP BY s),
weights AS (
  SELECT s, n, greatest(1, floor(sqrt(n) / (sum(sqrt(n)) OVER ()) * 1000 + 0.5))::BIGINT AS parts, row_number() OVER (ORDER BY s) AS i FROM totals
), whole AS (SELECT list(parts ORDER BY i) AS each_parts, list(s ORDER BY i) AS each_s, sum(parts)::BIGINT AS slots FROM weights),
sim(t, done, pick, nth) AS (
  SELECT -1::BIGINT, list_transform(each_parts, lambda x: 0::BIGINT), 0::BIGINT, 0::BIGINT FROM whole
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(done) + 1), lambda k: done[k] + CASE WHEN k = p THEN 1 ELSE 0 END), p, done[p]
  FROM (
    SELECT t, done, slots, list_min(list_filter(list_transform(range(1, len(done) + 1), lambda k:
      CASE WHEN done[k] < each_parts[k] AND (done[k] * slots) // each_parts[k] <= t + 1
           THEN ((done[k] + 1) * slots + each_parts[k] - 1) // each_parts[k] * 100000 + k END), lambda x: x IS NOT NULL)) % 100000 AS p
    FROM sim, whole WHERE t + 1 < slots
  )
), plan AS (SELECT each_s[pick] AS s, nth, t AS spot FROM sim, whole WHERE t >= 0),
horizon AS (
  SELECT min((n // 64) // parts * slots + spot) AS until
  FROM weights JOIN plan ON weights.s = plan.s AND (n // 64) % parts = nth, whole
), numbered AS (
  SELECT doc_id, source, s, row_number() OVER (PARTITION BY s ORDER BY h, doc_id) - 1 AS nth FROM keyed
)
SELECT doc_id, source, b.nth // 64 AS mix_block, (b.nth // 64) // parts * slots + spot AS mix_slot,
  ((b.nth // 64) // parts * slots + spot)::BIGINT * 64 + b.nth % 64 AS mix_position,
  (b.nth // 64) // parts * slots + spot < until AS mix_balanced
FROM numbered b JOIN weights ON b.s = weights.s JOIN plan ON plan.s = b.s AND plan.nth = (b.nth // 64) % parts, whole, horizon
"""
