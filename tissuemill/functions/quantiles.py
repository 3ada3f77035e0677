"""Exact quantiles of large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantiles(df: DataFrame, by: Sequence[str], value: str | Column, points: Sequence[float], extra: Sequence[Column] = (), accuracy: int = 10_000) -> DataFrame:
    """(by..., extra..., q): the ``points`` of each group's values, interpolated as ``percentile`` does, in the array q.

    ``percentile`` gathers all distinct values of a group in one task. Here a sketch of bounded size first gives two bounds
    around each point; then values between the bounds are counted, those below them as one, and only the former are ranked: some
    4 in ``accuracy`` of a group. The bounds lie a rank error of the sketch or more beyond what is sought, so results are
    exact; groups of up to 5 x ``accuracy`` values lie between their bounds as a whole. Nulls are left out (a group of
    nulls has null points) and NaN is the largest value. ``extra``: aggregates with aliases, of the sketch's pass.
    """
    by, points = list(by), [float(p) for p in points]
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    edges = [min(max(p + sign * 2 / accuracy, 0.0), 1.0) for p in points for sign in (-1, 1)]
    top = float("inf")
    stats = df.groupBy(*by).agg(F.count(v).alias("_n"), F.percentile_approx(F.when(F.isnan(v), top).otherwise(v), edges, accuracy).alias("_e"), *extra)
    carried = [c for c in stats.columns if c not in by and c != "_e"]
    small = F.col("_n") <= 5 * accuracy

    def bound(i: int) -> Column:
        low, high = F.get("_e", F.lit(2 * i)), F.get("_e", F.lit(2 * i + 1))
        return F.struct(F.lit(i).alias("i"), F.when(small, -top).otherwise(low).alias("low"), F.when(small | (high == top), float("nan")).otherwise(high).alias("high"))

    bounds = stats.select(*by, F.struct(*carried).alias("_s"), F.array(*map(bound, range(len(points)))).alias("_b"))
    rows = df.select(*by, v.alias("_v")).join(bounds, by)
    own = F.col("_v")
    hits = F.transform(F.filter("_b", lambda b: own <= b["high"]), lambda b: F.struct(b["i"].alias("i"), F.when(own >= b["low"], own).alias("key")))
    counts = rows.select(*by, "_s", F.explode_outer(hits).alias("_h")).groupBy(*by, "_s", F.col("_h.i").alias("_i"), F.col("_h.key").alias("_key")).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*by, "_i").orderBy(F.col("_key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    at = F.get(F.array(*map(F.lit, points)), F.col("_i")) * (F.col("_s._n") - 1)
    ranked = counts.withColumns({"_upto": upto, "_at": at})
    first = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_key")))
    found = ranked.groupBy(*by, "_s", "_i", "_at").agg(first(F.floor("_at")).alias("_low"), first(F.ceil("_at")).alias("_high"))
    a, low, high = F.col("_at"), F.col("_low"), F.col("_high")
    q = F.when(low == high, low).otherwise((F.ceil(a) - a) * low + (a - F.floor(a)) * high)
    out = found.groupBy(*by, "_s").agg(F.array(*[F.max(F.when(F.col("_i") == i, q)) for i in range(len(points))]).alias("q"))
    return out.select(*by, *[F.col(f"_s.{c}") for c in carried if c != "_n"], "q")
