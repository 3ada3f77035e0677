"""Pixel transforms. Images are pixels (sample_id, channel, y, x, value), stored as blocks (tiles) of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.quantiles import quantiles
from tissuemill.functions.scalar import clip, finite_or_zero, let
from tissuemill.functions.storage import materialise

TILE = 512
PLACE = ["sample_id", "channel", "y", "x"]


def to_pixels(tiles: DataFrame, value: str = "value") -> DataFrame:
    """A row for each pixel of the blocks; no shuffle."""
    other = [c for c in tiles.columns if c not in ("ty", "tx", "y0", "x0", "h", "w", "values")]
    out = tiles.select(*other, "y0", "x0", "w", F.posexplode("values").alias("_i", value))
    return out.select(*other, (F.col("y0") + F.expr("_i div w")).cast("int").alias("y"), (F.col("x0") + F.col("_i") % F.col("w")).cast("int").alias("x"), value)


def to_tiles(pixels: DataFrame, size: int = TILE, value: str = "value", by: Sequence[str] = ("sample_id", "channel")) -> DataFrame:
    """Blocks of ``size`` x ``size`` pixels (smaller at the far edges), row by row, missing pixels 0; one shuffle by block."""
    ty, tx = F.floor(F.col("y") / size).cast("int"), F.floor(F.col("x") / size).cast("int")
    blocks = pixels.withColumns({"ty": ty, "tx": tx}).groupBy(*by, "ty", "tx").agg(
        F.sort_array(F.collect_list(F.struct((F.col("y") % size).alias("r"), (F.col("x") % size).alias("c"), F.col(value).alias("v")))).alias("p"),
        (F.max(F.col("y") % size) + 1).cast("int").alias("h"), (F.max(F.col("x") % size) + 1).cast("int").alias("w"),
    )
    none = F.lit(0).cast(dict(pixels.dtypes)[value])

    def filled(s: Column) -> Column:
        at = lambda e: (e["r"] * s["w"] + e["c"]).cast("int")
        gap = lambda e, i: at(e) - F.coalesce(at(F.get(s["p"], i - 1)), F.lit(-1)) - 1
        rows = F.flatten(F.transform(s["p"], lambda e, i: F.concat(F.array_repeat(none, gap(e, i)), F.array(e["v"]))))
        return F.concat(rows, F.array_repeat(none, s["h"] * s["w"] - 1 - at(F.element_at(s["p"], -1))))

    values = let(F.struct("p", "h", "w"), filled)
    return blocks.select(*by, "ty", "tx", (F.col("ty") * size).alias("y0"), (F.col("tx") * size).alias("x0"), "h", "w", values.alias("values"))


# -- checks -----------------------------------------------------------------------------------------------------------


def check_shapes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Samples whose two images differ in height or width: sample_id and both sizes."""
    size = lambda df, n: df.groupBy("sample_id").agg((F.max("y") + 1).alias(f"height_{n}"), (F.max("x") + 1).alias(f"width_{n}"))
    both = size(a, "a").join(size(b, "b"), "sample_id", "full_outer")
    same = F.col("height_a").eqNullSafe(F.col("height_b")) & F.col("width_a").eqNullSafe(F.col("width_b"))
    return both.where(~same)


def check_one_plane(pixels: DataFrame) -> DataFrame:
    """Samples whose image isn't a single plane."""
    return pixels.groupBy("sample_id").agg(F.count_distinct("channel").alias("planes")).where("planes <> 1")


def check_not_blank(pixels: DataFrame) -> DataFrame:
    """Samples whose image is all zero after cleaning."""
    return pixels.groupBy("sample_id").agg(F.bool_and(finite_or_zero(F.col("value")) == 0).alias("blank")).where("blank").select("sample_id")


def clean_nonfinite(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", finite_or_zero(F.col("value")))


def clean_tiles(tiles: DataFrame) -> DataFrame:
    """``clean_nonfinite`` on blocks, whose values stay together."""
    return tiles.withColumn("values", F.transform("values", finite_or_zero))


def count_nonfinite(pixels: DataFrame) -> DataFrame:
    v = F.col("value")
    return pixels.groupBy("sample_id").agg(F.count_if(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))).alias("n_nonfinite"))


# -- geometry ---------------------------------------------------------------------------------------------------------


def permute_axes(pixels: DataFrame, order: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Transpose (channel, y, x): new axis i is old axis order[i]."""
    axes = ["channel", "y", "x"]
    return pixels.select(*[c for c in pixels.columns if c not in axes], *[F.col(axes[o]).alias(n) for n, o in zip(axes, order, strict=True)])


def normalise_axes(pixels: DataFrame) -> DataFrame:
    """Planes without a channel get channel 0; order of the array's axes is no matter in pixel form."""
    return pixels if "channel" in pixels.columns else pixels.withColumn("channel", F.lit(0))


def stack_channels(nuclear: DataFrame, membrane: DataFrame) -> DataFrame:
    """Channel 0 is the membrane, 1 the nuclear image. Shapes are checked by ``check_shapes``."""
    return membrane.withColumn("channel", F.lit(0)).unionByName(nuclear.withColumn("channel", F.lit(1)))


def stitch(pixels: DataFrame, regions: DataFrame) -> DataFrame:
    """Tiles' pixels (with path) placed on one canvas per sample; where tiles overlap, the first path wins.

    ``regions``: sample_id, path, x, y of each tile. The canvas is the tiles' bounding box, from its own corner; gaps have no
    pixel. Pixels are combined map-side; in block form gaps are 0 (``to_tiles``).
    """
    corner = regions.groupBy("sample_id").agg(F.min("x").alias("_left"), F.min("y").alias("_top"))
    at = regions.join(corner, "sample_id").select("sample_id", "path", (F.col("x") - F.col("_left")).alias("_x"), (F.col("y") - F.col("_top")).alias("_y"))
    moved = pixels.join(at, ["sample_id", "path"]).withColumns({"y": (F.col("y") + F.col("_y")).cast("int"), "x": (F.col("x") + F.col("_x")).cast("int")})
    return moved.groupBy(*PLACE).agg(F.min_by("value", "path").alias("value"))


def downscale(pixels: DataFrame, k: int, integer: bool = False) -> DataFrame:
    """Means of k x k blocks, after cropping height and width to multiples of k; integer images are rounded half to even."""
    if k == 1:
        return pixels
    size = pixels.groupBy("sample_id").agg((F.floor((F.max("y") + 1) / k) * k).alias("_h"), (F.floor((F.max("x") + 1) / k) * k).alias("_w"))
    inside = pixels.join(materialise(size), "sample_id").where("y < _h and x < _w")  # written, so that Spark knows its size
    mean = F.avg("value")
    return inside.groupBy("sample_id", "channel", F.floor(F.col("y") / k).cast("int").alias("y"), F.floor(F.col("x") / k).cast("int").alias("x")).agg((F.rint(mean) if integer else mean).alias("value"))


def downscale_by(pixels: DataFrame, factors: DataFrame, integer: bool = False) -> DataFrame:
    """``downscale`` with a factor of its own for each sample (``factors``: sample_id, k)."""
    k = F.col("_k")
    own = pixels.join(factors.select("sample_id", F.col("k").cast("int").alias("_k")), "sample_id")
    size = own.groupBy("sample_id").agg(F.max("y").alias("_y"), F.max("x").alias("_x"))
    inside = own.join(size, "sample_id").where((F.col("y") < F.floor((F.col("_y") + 1) / k) * k) & (F.col("x") < F.floor((F.col("_x") + 1) / k) * k))
    mean = F.avg("value")
    place = [F.floor(F.col(c) / k).cast("int").alias(c) for c in ("y", "x")]
    return inside.groupBy("sample_id", "channel", *place).agg((F.rint(mean) if integer else mean).alias("value"))


def downscale_tiles(tiles: DataFrame, k: int, integer: bool = False) -> DataFrame:
    """The same inside each block, without a shuffle: block sides must be multiples of k but at the far edges."""
    if k == 1:
        return tiles
    h, w = F.expr(f"h div {k}").cast("int"), F.expr(f"w div {k}").cast("int")

    def mean(t: Column, i: Column) -> Column:
        wide = F.greatest(t["w2"], F.lit(1))
        r, c = F.floor(i / wide), i % wide
        cells = [F.get(t["values"], ((r * k + a) * t["w"] + c * k + b).cast("int")) for a in range(k) for b in range(k)]
        m = sum(cells[1:], cells[0]) / (k * k)
        return F.rint(m) if integer else m

    sized = tiles.withColumns({"h2": h, "w2": w}).where("h2 > 0 and w2 > 0")
    values = let(F.struct("values", "w", "h2", "w2"), lambda t: F.transform(F.sequence(F.lit(0), t["h2"] * t["w2"] - 1), lambda i: mean(t, i)))
    new = {"values": values, "y0": F.expr(f"y0 div {k}").cast("int"), "x0": F.expr(f"x0 div {k}").cast("int"), "h": F.col("h2"), "w": F.col("w2")}
    return sized.select(*[new.get(c, F.col(c)).alias(c) for c in tiles.columns])


def build_pyramid(pixels: DataFrame, factors: Sequence[int], integer: bool = False) -> DataFrame:
    """The image at each factor, with its level (0 is the first factor)."""
    levels = [downscale(pixels, k, integer).select("sample_id", F.lit(i).alias("level"), "channel", "y", "x", "value") for i, k in enumerate(factors)]
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


# -- background -------------------------------------------------------------------------------------------------------


def bg_mean(pixels: DataFrame) -> DataFrame:
    """Less the image's mean, at least 0. Means are one row per sample and channel."""
    mean = pixels.groupBy("sample_id", "channel").agg(F.avg("value").alias("_mean"))
    return pixels.join(mean, ["sample_id", "channel"]).withColumn("value", clip(F.col("value") - F.col("_mean"), 0)).drop("_mean")


def bg_af(dapi: DataFrame, af: DataFrame) -> DataFrame:
    """Less the autofluorescence image, at least 0. Both images must have the same pixels (``check_shapes``)."""
    other = af.select("sample_id", "y", "x", F.col("value").alias("_af"))
    return dapi.join(other, ["sample_id", "y", "x"]).withColumn("value", clip(F.col("value") - F.col("_af"), 0)).select(*dapi.columns)


def bg_none(pixels: DataFrame) -> DataFrame:
    return pixels


# -- masks and overlays -----------------------------------------------------------------------------------------------


def outer_boundaries(mask: DataFrame) -> DataFrame:
    """(sample_id, plane, y, x, value): 255 on outer boundaries of a mask of all pixels (cell_id 0: background), else 0.

    A boundary pixel has another label among its four neighbours, and either is background or has two or more different
    non-zero labels around it (eight neighbours and itself). Each pixel is sent to its nine neighbours and combined map-side.
    """
    place = ["sample_id", "plane", "y", "x"]
    shifts = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    sent = mask.select("sample_id", "plane", "y", "x", "cell_id", F.explode(shifts).alias("s"))
    sent = sent.select("sample_id", "plane", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x"), "cell_id", (F.abs("s.dy") + F.abs("s.dx")).alias("far"))
    c, near = F.col("cell_id"), F.col("far") <= 1
    around = sent.groupBy(*place).agg(
        F.max(F.when(F.col("far") == 0, c)).alias("own"),
        F.min(F.when(near, c)).alias("low4"), F.max(F.when(near, c)).alias("high4"),
        F.min(F.when(c != 0, c)).alias("low8"), F.max(F.when(c != 0, c)).alias("high8"),
    ).where("own is not null")
    edge = (F.col("low4") != F.col("high4")) & ((F.col("own") == 0) | (F.col("low8") != F.col("high8")))
    return around.select(*place, F.when(edge, 255).otherwise(0).alias("value"))


def bw_overlay(dapi: DataFrame, boundary: DataFrame, binary: bool = True) -> DataFrame:
    """Channel 0 is the image, channel 1 the boundary (as 0 and 255 unless it already is)."""
    line = F.col("value").cast("double") if not binary else F.when(F.col("value") > 0, 255.0).otherwise(0.0)
    columns = ["sample_id", "channel", "y", "x", "value"]
    return dapi.withColumn("channel", F.lit(0)).select(*columns).unionByName(boundary.withColumn("channel", F.lit(1)).withColumn("value", line).select(*columns))


def overlay_limits(dapi: DataFrame, approx: int | None = None) -> DataFrame:
    """(sample_id, q): each image's 1st and 99.5th percentile."""
    points = [0.01, 0.995]
    return dapi.groupBy("sample_id").agg(F.percentile_approx("value", points, approx).alias("q")) if approx else quantiles(dapi, ["sample_id"], "value", points)


def rgb_overlay(dapi: DataFrame, boundary: DataFrame, approx: int | None = None) -> DataFrame:
    """(sample_id, y, x, r, g, b): blue is the image between its 1st and 99.5th percentile, red the boundary."""
    limits = overlay_limits(dapi, approx).withColumnRenamed("q", "_q")
    low, high = F.get("_q", F.lit(0)), F.get("_q", F.lit(1))
    lines = boundary.select("sample_id", "y", "x", F.col("value").alias("_line"))
    both = dapi.join(limits, "sample_id").join(lines, ["sample_id", "y", "x"])
    blue = clip(F.try_divide(F.col("value") - low, high - low) * 255, 0, 255).cast("int")
    return both.select("sample_id", "y", "x", F.when(F.col("_line") > 0, 255).otherwise(0).alias("r"), F.lit(0).alias("g"), blue.alias("b"))


# -- thresholds -------------------------------------------------------------------------------------------------------


def intensity_histogram(pixels: DataFrame, bins: int = 256, integer: bool = False) -> DataFrame:
    """(sample_id, bin, centre, n) over each image's range; integer images: a bin for each value. Empty bins have no row.

    An image is one group, so only its range and its bins' counts are shuffled, both pre-aggregated.
    """
    if integer:
        return pixels.groupBy("sample_id", F.col("value").cast("long").alias("bin")).agg(F.first("value").alias("centre"), F.count("*").alias("n"))
    ends = pixels.groupBy("sample_id").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    return binned(pixels.join(ends, "sample_id"), bins)


def binned(pixels: DataFrame, bins: int) -> DataFrame:
    """Counts of pixels that have their image's range (_low, _high), by equal bins of it."""
    width = (F.col("_high") - F.col("_low")) / bins
    at = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins), F.lit(bins - 1))).otherwise(0)
    placed = pixels.withColumn("bin", at).withColumn("centre", F.when(width > 0, F.col("_low") + (F.col("bin") + 0.5) * width).otherwise(F.col("_low")))
    return placed.groupBy("sample_id", "bin", "centre").agg(F.count("*").alias("n"))


def otsu(pixels: DataFrame, leniency: float = 0.0, bins: int = 256, integer: bool = False) -> DataFrame:
    """(sample_id, threshold, adjusted): the bin centre after which the variance between classes is largest; first of equals."""
    return otsu_of(intensity_histogram(pixels, bins, integer), leniency)


def otsu_of(histogram: DataFrame, leniency: float = 0.0) -> DataFrame:
    """``otsu`` from a histogram: running sums over a sample's bins only. A constant image's threshold is its value."""
    h = histogram.withColumn("nc", F.col("n") * F.col("centre"))
    by = Window.partitionBy("sample_id").orderBy("bin")
    low, high = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(1, Window.unboundedFollowing)
    w1, w2 = F.sum("n").over(low), F.sum("n").over(high)
    split = h.withColumn("var", w1 * w2 * F.pow(F.sum("nc").over(low) / w1 - F.sum("nc").over(high) / w2, F.lit(2)))
    best = split.groupBy("sample_id").agg(F.max_by("centre", F.struct(F.coalesce("var", F.lit(-1.0)), -F.col("bin"))).alias("threshold"))
    return best.withColumn("adjusted", F.col("threshold") * (1 - leniency))


def binarise(pixels: DataFrame, thresholds: DataFrame) -> DataFrame:
    cut = thresholds.select("sample_id", "adjusted")
    return pixels.join(cut, "sample_id").withColumn("value", F.when(F.col("value") > F.col("adjusted"), 255).otherwise(0)).select(*pixels.columns)
