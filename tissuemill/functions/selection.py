"""The first rows of large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.storage import materialise


def first_rows(rows: DataFrame, by: Sequence[str], n: int, ranges: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """The ``n`` rows of each group that come first by ``order``; groups with fewer whole. No window holds a whole group.

    ``ranges``: ever finer numbers that never fall as rows go on in ``order``. Rows are counted by range, which Spark does in each
    task first: ranges before the one that the n-th row lies in are taken whole, and only that one's rows go on to the finer ranges. What is
    left at the end is ranked. ``rows`` are read several times: write them before.
    """
    by = list(by)
    rest, parts = rows.withColumn("_left", F.lit(n).cast("long")), []
    for number in ranges:
        at = rest.withColumn("_range", number)
        before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        counts = at.groupBy(*by, "_left", "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
        counts = materialise(counts.where(F.col("_before") < F.col("_left")))
        inside = F.col("_before") + F.col("_n") <= F.col("_left")
        parts.append(at.join(counts.where(inside).select(*by, "_range"), [*by, "_range"], "left_semi").select(*rows.columns))
        edge = counts.where(~inside).select(*by, "_range", (F.col("_left") - F.col("_before")).alias("_more"))
        rest = at.drop("_left").join(edge, [*by, "_range"]).withColumnRenamed("_more", "_left").drop("_range")
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    out = rest.withColumn("_nth", nth).where(F.col("_nth") <= F.col("_left")).select(*rows.columns)
    for part in parts:
        out = out.unionByName(part)
    return out
