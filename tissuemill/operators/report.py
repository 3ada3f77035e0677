"""Quality-control tables of the cell table: summaries, centred log-ratios, densities, correlations, Q-Q points.

All keys start with sample_id. Wide tables have a column for each marker; long ones have (sample_id, cell_id, marker, value).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.quantiles import quantiles
from tissuemill.functions.scalar import normal_quantile
from tissuemill.functions.storage import materialise

CELL = ["sample_id", "cell_id"]
NUCLEAR = "DAPI"


# -- markers and cells ------------------------------------------------------------------------------------------------


def effective_markers(markers: DataFrame, columns: Sequence[str]) -> list[str]:
    """Marker names of the sheet that are columns of the data, in sheet order, each once. The sheet is small."""
    present = set(columns)
    names = [r["marker_name"] for r in markers.select("marker_name", "marker_idx").orderBy("marker_idx").collect()]
    return [n for n in dict.fromkeys(names) if n in present]


def missing_markers(markers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sheet rows whose marker isn't a column of the data."""
    return markers.where(~F.col("marker_name").isin(list(columns)))


def marker_columns(effective: Sequence[str], nuclear: str = NUCLEAR) -> list[str]:
    return [m for m in effective if m != nuclear]


def meta_columns(columns: Sequence[str], markers: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in set(markers)]


def distinct_cells(df: DataFrame) -> DataFrame:
    return df.select(*CELL).distinct()


def keep_cells(df: DataFrame, cells: DataFrame) -> DataFrame:
    return df.join(cells.select(*CELL), CELL, "left_semi")


def drop_cells(df: DataFrame, cells: DataFrame) -> DataFrame:
    return df.join(cells.select(*CELL), CELL, "left_anti")


def to_long(cells: DataFrame, markers: Sequence[str], *keep: str) -> DataFrame:
    """One row for each cell row and marker; no shuffle."""
    return cells.unpivot([*CELL, *keep], [F.col(f"`{m}`") for m in markers], "marker", "value")


def flag_extreme_cells(long: DataFrame, limit: float = 1e30) -> DataFrame:
    """Cells whose values sum to over ``limit``; rows that share an id are pooled."""
    return long.groupBy(*CELL).agg(F.sum("value").alias("total")).where(F.col("total") > limit)


def make_unique(cells: DataFrame, order: str) -> DataFrame:
    """cell_id as text, later repeats with .1, .2, ... in the order of ``order``; a suffix that is taken already is skipped.

    Only ids that repeat are touched: for them the free suffixes are found among the sample's own ids, by a join on the
    name a suffix would give.
    """
    ids = cells.withColumn("cell_id", F.col("cell_id").cast("string"))
    nth = F.row_number().over(Window.partitionBy(*CELL).orderBy(order)) - 1
    numbered = ids.withColumn("_nth", nth)
    once = numbered.where("_nth = 0").select("sample_id", F.col("cell_id").alias("_taken"))
    most = numbered.groupBy(*CELL).agg(F.max("_nth").alias("_most")).where("_most > 0")
    # names that exist may use up suffixes: as many more are tried as ids of the form <id>.<number> exist
    stem = F.regexp_extract("_taken", r"^(.*)\.\d+$", 1)
    used = once.where(F.col("_taken").rlike(r"\.\d+$")).groupBy("sample_id", stem.alias("cell_id")).agg(F.count("*").alias("_used"))
    tries = most.join(used, CELL, "left").select(*CELL, F.explode(F.sequence(F.lit(1), (F.col("_most") + F.coalesce("_used", F.lit(0))).cast("int"))).alias("_k"))
    named = tries.withColumn("_taken", F.concat_ws(".", "cell_id", "_k"))
    free = named.join(once, ["sample_id", "_taken"], "left_anti")
    free = free.withColumn("_nth", F.row_number().over(Window.partitionBy(*CELL).orderBy("_k"))).select(*CELL, "_nth", "_taken")
    out = numbered.join(free, [*CELL, "_nth"], "left")
    return out.withColumn("cell_id", F.coalesce("_taken", "cell_id")).select(*[F.col(f"`{c}`") for c in cells.columns])


# -- summaries --------------------------------------------------------------------------------------------------------


def area_summary(cells: DataFrame, area: str = "Area") -> DataFrame:
    a = F.col(area)
    rest = [F.round(F.avg(a), 2).alias("mean"), F.round(F.stddev_samp(a), 2).alias("sd"), F.min(a).alias("min"), F.max(a).alias("max")]
    return quantiles(cells, ["sample_id"], a, [0.5], rest).select("sample_id", "mean", F.get("q", F.lit(0)).alias("median"), "sd", "min", "max")


def _quantiles(df: DataFrame, by: Sequence[str], value: str, points: Sequence[float], approx: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """The array q of each group's points: exact, or of an accuracy of ``approx``."""
    if not approx:
        return quantiles(df, by, value, points, extra)
    return df.groupBy(*by).agg(*extra, F.percentile_approx(value, [float(p) for p in points], approx).alias("q"))


def marker_summary(long: DataFrame, value: str = "value", approx: int | None = None) -> DataFrame:
    """Mean, median, sd, min and max of each marker. ``approx``: accuracy of an approximate median of bounded memory."""
    v = F.col(value)
    rest = [F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.min(v).alias("min"), F.max(v).alias("max")]
    return _quantiles(long, ["sample_id", "marker"], value, [0.5], approx, rest).select("sample_id", "marker", "mean", F.get("q", F.lit(0)).alias("median"), "sd", "min", "max")


def clr(long: DataFrame) -> DataFrame:
    """``clr``: log(v+1) less the mean of it over the cell's markers (NaN left out of the mean)."""
    logged = F.log1p("value")
    usable = F.when(~F.isnan(logged), logged)
    return long.withColumn("clr", logged - F.avg(usable).over(Window.partitionBy(*CELL)))


def clr_wide(cells: DataFrame, markers: Sequence[str]) -> DataFrame:
    """The same on the wide table, where a row is a cell: row by row, without a shuffle. Ids must be unique."""
    logged = {m: F.log1p(F.col(f"`{m}`")) for m in markers}
    usable = [F.when(~F.isnan(x), x) for x in logged.values()]
    mean = sum((F.coalesce(x, F.lit(0.0)) for x in usable), F.lit(0.0)) / sum((F.when(x.isNotNull(), 1).otherwise(0) for x in usable), F.lit(0))
    return cells.withColumns({m: x - mean for m, x in logged.items()})


def marker_summary_clr(long: DataFrame) -> DataFrame:
    return marker_summary(clr(long), "clr")


def count_cells(df: DataFrame) -> DataFrame:
    return df.groupBy("sample_id").agg(F.count_distinct("cell_id").alias("n_cells"))


def cell_totals(long: DataFrame) -> DataFrame:
    """Each cell's sum of values, and how many of its markers are above zero."""
    return long.groupBy(*CELL).agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("n_positive"))


def correlation_matrix(cells: DataFrame, markers: Sequence[str]) -> DataFrame:
    """(sample_id, marker_a, marker_b, r): lower triangle with diagonal of Pearson's r, to 2 digits.

    For any number of markers: every task adds up products of its own cells as matrices, and what is shuffled and added are a task's sums
    of each pair. A cell counts for a pair if it has both values. r is null where either is constant, or no cell has
    both, and NaN where one is. Values are taken from their sample's least, so that sums don't cancel out.
    """
    d = len(markers)
    low, high = np.tril_indices(d)  # marker_a comes after marker_b, or is the same
    v = F.array(*[F.col(f"`{m}`").cast("double") for m in markers])
    least = materialise(cells.groupBy("sample_id").agg(F.array(*[F.coalesce(F.min(F.col(f"`{m}`").cast("double")), F.lit(0.0)) for m in markers]).alias("_least")))
    shifted = cells.select("sample_id", v.alias("v")).join(least, "sample_id").select("sample_id", F.zip_with("v", "_least", lambda x, m: F.coalesce(x - m, F.lit(0.0))).alias("v"), F.transform("v", lambda x: x.isNotNull().cast("double")).alias("there"))
    names = ["n", "sa", "sb", "qa", "qb", "p"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for sample, part in batch.groupby("sample_id", dropna=False):
                x, there = np.stack(part.v), np.stack(part.there)
                s, q = x.T @ there, (x * x).T @ there
                sums = np.stack([(there.T @ there)[low, high], s[low, high], s.T[low, high], q[low, high], q.T[low, high], (x.T @ x)[low, high]])
                held[sample] = held.get(sample, 0) + sums
        yield pd.DataFrame([(k, *m) for k, m in held.items()], columns=["sample_id", *names])

    tasks = shifted.mapInPandas(run, "sample_id string, " + ", ".join(f"{n} array<double>" for n in names))
    each = tasks.select("sample_id", F.posexplode(F.arrays_zip(*names)).alias("i", "s")).groupBy("sample_id", "i").agg(*[F.sum(f"s.{n}").alias(n) for n in names])
    spread = lambda q, s: F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
    r = F.try_divide(F.col("p") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n")), F.sqrt(F.greatest(spread("qa", "sa"), F.lit(0.0)) * F.greatest(spread("qb", "sb"), F.lit(0.0))))
    named = lambda at: F.get(F.array(*[F.lit(markers[k]) for k in at.tolist()]), F.col("i"))
    return each.select("sample_id", named(low).alias("marker_a"), named(high).alias("marker_b"), F.round(r, 2).alias("r"))


def box_stats(long: DataFrame, value: str = "value", approx: int | None = None) -> DataFrame:
    """q1, median, q3, whiskers and the number of outliers of each marker."""
    by = ["sample_id", "marker"]
    q = _quantiles(long, by, value, (0.25, 0.5, 0.75), approx)
    q = q.select(*by, *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    v, reach = F.col(value), 1.5 * (F.col("q3") - F.col("q1"))
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    return long.join(q, by).groupBy(*by).agg(
        *[F.first(n).alias(n) for n in ("q1", "median", "q3")],
        F.min(F.when(inside, v)).alias("low_whisker"), F.max(F.when(inside, v)).alias("high_whisker"), F.count_if(~inside).alias("n_outliers"),
    )


def box_outliers(long: DataFrame, value: str = "value") -> DataFrame:
    """The rows beyond the whiskers of their marker."""
    by = ["sample_id", "marker"]
    q = _quantiles(long, by, value, (0.25, 0.75)).withColumnRenamed("q", "_q")
    low, high = F.get("_q", F.lit(0)), F.get("_q", F.lit(1))
    reach = 1.5 * (high - low)
    return long.join(q, by).where(~F.col(value).between(low - reach, high + reach)).drop("_q")


# -- densities --------------------------------------------------------------------------------------------------------


def bandwidths(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """n, low, high and the rule-of-thumb bandwidth of each group: 0.9 min(sd, IQR/1.34) n^-0.2, with fallbacks for 0."""
    v = F.col(value)
    rest = [F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.stddev_samp(v).alias("sd")]
    stats = _quantiles(df, by, value, (0.25, 0.75), None, rest)
    spread = (F.get("q", F.lit(1)) - F.get("q", F.lit(0))) / 1.34
    least = F.least("sd", spread)
    width = F.when(least > 0, least).when(F.col("sd") > 0, F.col("sd")).when(F.abs("low") > 0, F.abs("low")).otherwise(1.0)
    return stats.select(*by, "n", "low", "high", (0.9 * width * F.pow("n", F.lit(-0.2))).alias("bw"))


def density(df: DataFrame, by: Sequence[str], value: str = "value", points: int = 512) -> DataFrame:
    """(by..., k, x, density): Gaussian kernel density on ``points`` grid points over each group's range.

    Values are first shared out to their two neighbouring grid points, which shrinks a group to ``points`` weights before the
    shuffle; the kernel then runs over weights and grid.
    """
    by = list(by)
    bw = bandwidths(df, by, value)
    step = (F.col("high") - F.col("low")) / (points - 1)
    at = F.when(step > 0, (F.col(value) - F.col("low")) / step).otherwise(0.0)
    left = F.least(F.floor(at), F.lit(points - 2))
    shared = df.where(F.col(value).isNotNull()).join(bw.select(*by, "low", "high"), by).select(*by, left.alias("left"), (at - left).alias("part"))
    bins = shared.select(*by, F.explode(F.array(F.struct(F.col("left").alias("bin"), (1 - F.col("part")).alias("w")), F.struct((F.col("left") + 1).alias("bin"), F.col("part").alias("w")))).alias("b"))
    bins = bins.groupBy(*by, F.col("b.bin").alias("bin")).agg(F.sum("b.w").alias("w")).where("w > 0")
    joined = bins.join(bw, by).withColumn("step", step).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    z = (F.col("k") - F.col("bin")) * F.col("step") / F.col("bw")
    kernel = F.sum(F.col("w") * F.exp(-0.5 * z * z)) / (F.first("n") * F.first("bw") * (2 * 3.141592653589793) ** 0.5)
    return joined.groupBy(*by, "k").agg((F.first("low") + F.col("k") * F.first("step")).alias("x"), kernel.alias("density"))


def density_exact(df: DataFrame, by: Sequence[str], value: str = "value", points: int = 512) -> DataFrame:
    """The same without sharing values out to the grid: every value meets every grid point (for checks)."""
    by = list(by)
    bw = bandwidths(df, by, value)
    step = (F.col("high") - F.col("low")) / (points - 1)
    grid = df.where(F.col(value).isNotNull()).join(bw, by).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x", F.col("low") + F.col("k") * step)
    z = (F.col("x") - F.col(value)) / F.col("bw")
    return grid.groupBy(*by, "k").agg(F.first("x").alias("x"), (F.sum(F.exp(-0.5 * z * z)) / (F.first("n") * F.first("bw") * (2 * 3.141592653589793) ** 0.5)).alias("density"))


# -- sampling and Q-Q -------------------------------------------------------------------------------------------------


def sample_cells(long: DataFrame, n: int = 100_000, seed: int = 0) -> DataFrame:
    """Rows of ``n`` distinct cells of each sample that has more; the others whole. The n least hashes are taken.

    Samples are cut by the n-th hash in two steps, so that no window holds a whole sample: hashes are first counted in
    4096 ranges, and only the range in which the n-th lies is ranked.
    """
    cells = distinct_cells(long).withColumn("_hash", F.md5(F.concat_ws(":", "sample_id", F.col("cell_id").cast("string"), F.lit(seed).cast("string")).cast("binary")))
    cells = cells.withColumn("_range", F.substring("_hash", 1, 3))
    ranges = cells.groupBy("sample_id", "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("sample_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("_before", before).where(F.col("_before") < n)
    whole = cells.join(ranges.where(F.col("_before") + F.col("_n") <= n), ["sample_id", "_range"], "left_semi")
    edge = cells.join(ranges.where(F.col("_before") + F.col("_n") > n), ["sample_id", "_range"])
    nth = F.row_number().over(Window.partitionBy("sample_id", "_range").orderBy("_hash", "cell_id"))
    edge = edge.withColumn("_nth", nth).where(F.col("_nth") + F.col("_before") <= n)
    return keep_cells(long, whole.select(*CELL).union(edge.select(*CELL)))


def qq_points(long: DataFrame, value: str = "value", run: int = 1 << 20) -> DataFrame:
    """(sample_id, marker, i, theoretical, sample): sorted values against normal quantiles.

    Equal values are counted first; the distinct ones lie in ranges over all samples and markers, which are written with their
    numbers. A range's values are ranked in the range, after the counts of the ranges before: no window holds a marker. As
    in the report, large samples go through ``sample_cells`` before. Ranks of equal values are written out ``run`` at a time.
    """
    by = ["sample_id", "marker"]
    counts = long.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("sample")).agg(F.count("*").alias("c"))
    ranged = materialise(counts.repartitionByRange(*by, "sample").withColumn("_part", F.spark_partition_id()))
    parts = ranged.groupBy(*by, "_part").agg(F.sum("c").alias("_n"))  # a row for each range that a marker reaches into
    earlier = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = materialise(parts.select(*by, "_part", F.coalesce(earlier, F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*by)).alias("n")))
    within = Window.partitionBy(*by, "_part").orderBy("sample").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.withColumn("_upto", F.sum("c").over(within)).join(parts, [*by, "_part"]).withColumn("_first", F.col("_before") + F.col("_upto") - F.col("c"))
    runs = ranked.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / run))))
    last = F.col("_first") + F.least(F.col("c"), (F.col("_run") + 1) * run)
    rows = runs.select(*by, "n", F.explode(F.sequence(F.col("_first") + F.col("_run") * run + 1, last)).alias("i"), "sample")
    a = F.when(F.col("n") <= 10, 0.375).otherwise(0.5)
    return rows.select(*by, "i", normal_quantile((F.col("i") - a) / (F.col("n") + 1 - 2 * a)).alias("theoretical"), "sample")


def qq_line(long: DataFrame, value: str = "value") -> DataFrame:
    """Slope and intercept of the line through the quartiles of each marker."""
    q = _quantiles(long, ["sample_id", "marker"], value, (0.25, 0.75))
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    z = normal_quantile(F.lit(0.75))
    return q.select("sample_id", "marker", ((high - low) / (2 * z)).alias("slope"), (low + (high - low) / 2).alias("intercept"))
