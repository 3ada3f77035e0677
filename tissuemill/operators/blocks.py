"""Image geometry on blocks: cutting along a grid, pasting, stitching, rescaling, pyramids, thresholds, masks.

A block is one row: sample_id, channel, its place on a grid (ty, tx), its top left pixel (y0, x0), h, w, and its values row by
row. What is shuffled are parts of blocks as arrays; there is no row for a pixel.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuemill.functions.scalar import clip, let
from tissuemill.functions.storage import materialise
from tissuemill.operators import pixels

TILE = pixels.TILE
BLOCK = ["ty", "tx", "y0", "x0", "h", "w", "values"]


def crop(values: Column, h: Column, w: Column, top: Column, left: Column, rows: Column, cols: Column) -> Column:
    """A rectangle of a block's values, row by row; of each layer, where the values hold several one after the other."""

    def cut(s: Column) -> Column:
        layers = F.floor(F.size(s["v"]) / (s["h"] * s["w"]))
        lines = F.sequence(F.lit(0).cast("long"), layers * s["rows"] - 1)
        start = lambda i: (F.floor(i / s["rows"]) * s["h"] + s["top"] + i % s["rows"]) * s["w"] + s["left"] + 1
        return F.flatten(F.transform(lines, lambda i: F.slice(s["v"], start(i).cast("int"), s["cols"])))

    whole = (top == 0) & (left == 0) & (rows == h) & (cols == w)
    parts = {"v": values, "h": h, "w": w, "top": top, "left": left, "rows": rows, "cols": cols}
    return F.when(whole, values).otherwise(let(F.struct(*[c.cast("int").alias(n) if n != "v" else c.alias(n) for n, c in parts.items()]), cut))


def cut(tiles: DataFrame, size: int) -> DataFrame:
    """Blocks of any place and shape cut along the lines of a grid of ``size``; ty and tx are the grid's. No shuffle."""
    steps = lambda low, n: F.sequence(F.floor(F.col(low) / size), F.floor((F.col(low) + F.col(n) - 1) / size))
    other = [c for c in tiles.columns if c not in BLOCK]
    met = tiles.where("h > 0 and w > 0").withColumn("ty", F.explode(steps("y0", "h"))).withColumn("tx", F.explode(steps("x0", "w")))
    top, left = F.greatest(F.col("y0"), F.col("ty") * size), F.greatest(F.col("x0"), F.col("tx") * size)
    rows = F.least(F.col("y0") + F.col("h"), (F.col("ty") + 1) * size) - top
    cols = F.least(F.col("x0") + F.col("w"), (F.col("tx") + 1) * size) - left
    values = crop(F.col("values"), F.col("h"), F.col("w"), top - F.col("y0"), left - F.col("x0"), rows, cols)
    whole = lambda c: c.cast("int")
    return met.select(*other, whole(F.col("ty")).alias("ty"), whole(F.col("tx")).alias("tx"), whole(top).alias("y0"), whole(left).alias("x0"), whole(rows).alias("h"), whole(cols).alias("w"), values.alias("values"))


def paste(pieces: DataFrame, size: int, add: bool = False) -> DataFrame:
    """Blocks of a grid from their pieces (``cut``); each piece has its canvas' height and width. One shuffle, of pieces.

    Where pieces overlap they are added up, or the first path wins (``pieces`` then have a path). Gaps in a block are 0; a
    block without pieces has no row.
    """
    kind = dict(pieces.dtypes)["values"]
    names = ["sample_id", "channel", *BLOCK]

    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        sample, channel, ty, tx = key
        h, w = min(size, int(parts.height.iloc[0]) - ty * size), min(size, int(parts.width.iloc[0]) - tx * size)
        area = np.zeros((h, w), parts["values"].iloc[0].dtype)
        for p in (parts if add else parts.sort_values("path", ascending=False)).itertuples():
            y, x = p.y0 - ty * size, p.x0 - tx * size
            part = p.values.reshape(p.h, p.w)
            area[y : y + p.h, x : x + p.w] = area[y : y + p.h, x : x + p.w] + part if add else part
        return pd.DataFrame([(sample, channel, ty, tx, ty * size, tx * size, h, w, area.ravel())], columns=names)

    kept = pieces.select(*[c for c in pieces.columns if c in (*names, "path", "height", "width")])
    return kept.groupBy("sample_id", "channel", "ty", "tx").applyInPandas(run, f"sample_id string, channel int, ty int, tx int, y0 int, x0 int, h int, w int, values {kind}")


def stitch_tiles(tiles: DataFrame, regions: DataFrame, size: int = TILE) -> DataFrame:
    """``pixels.stitch`` on blocks: fields' blocks (with path, from each field's own corner) to one canvas' blocks per sample.

    Every field's place meets the canvas' grid by arithmetic; blocks are cut along it, and only a grid block's pieces meet. The
    canvas is the fields' bounding box; where fields overlap the first path wins; gaps are 0.
    """
    extent = tiles.groupBy("sample_id", "path").agg(F.max(F.col("y0") + F.col("h")).alias("_h"), F.max(F.col("x0") + F.col("w")).alias("_w"))
    placed = regions.select("sample_id", "path", F.col("y").cast("long").alias("_y"), F.col("x").cast("long").alias("_x")).join(extent, ["sample_id", "path"])
    box = placed.groupBy("sample_id").agg(F.min("_y").alias("_top"), F.min("_x").alias("_left"), F.max(F.col("_y") + F.col("_h")).alias("_end"), F.max(F.col("_x") + F.col("_w")).alias("_side"))
    frame = placed.join(box, "sample_id").select("sample_id", "path", (F.col("_y") - F.col("_top")).alias("_dy"), (F.col("_x") - F.col("_left")).alias("_dx"), (F.col("_end") - F.col("_top")).cast("int").alias("height"), (F.col("_side") - F.col("_left")).cast("int").alias("width"))
    moved = tiles.join(materialise(frame), ["sample_id", "path"])  # written, so that Spark knows its size and broadcasts it if it may
    moved = moved.withColumns({"y0": F.col("y0") + F.col("_dy"), "x0": F.col("x0") + F.col("_dx")}).drop("_dy", "_dx")
    return paste(cut(moved, size), size)


def _summed(values: np.ndarray, y0: int, x0: int, k: int, height: int, width: int) -> tuple[int, int, np.ndarray]:
    """Sums of a block over the k x k squares of the image that it meets, cropped to ``height`` x ``width``, and their place."""
    values = values[: max(0, height - y0), : max(0, width - x0)]
    if not values.size:
        return 0, 0, np.zeros((0, 0))
    out = values.astype(float)
    for axis, low in ((0, y0), (1, x0)):
        at = (low + np.arange(out.shape[axis])) // k
        out = np.add.reduceat(out, np.flatnonzero(np.diff(at, prepend=-1)), axis=axis)
    return y0 // k, x0 // k, out


def rescale_tiles(tiles: DataFrame, factors: DataFrame, size: int = TILE, integer: bool = False, total: bool = False) -> DataFrame:
    """``pixels.downscale_by`` on blocks: each sample by its own factor (``factors``: sample_id, k), to blocks of a grid of ``size``.

    Blocks may have any place and shape. Each adds up its own part of every k x k square before anything is shuffled, so that
    what is shuffled has the output's size; a square that block edges cut is added up from its parts. Height and width are
    cropped to multiples of k. ``integer``: means are rounded half to even; ``total``: sums, not means.
    """
    extent = tiles.groupBy("sample_id").agg(F.max(F.col("y0") + F.col("h")).alias("_h"), F.max(F.col("x0") + F.col("w")).alias("_w"))
    k = F.col("k").cast("int")
    frame = materialise(extent.join(factors.select("sample_id", k.alias("k")), "sample_id").select("sample_id", "k", F.expr("_h div k").cast("int").alias("height"), F.expr("_w div k").cast("int").alias("width")))
    own = tiles.join(frame, "sample_id").select("sample_id", F.col("channel").cast("int").alias("channel"), "y0", "x0", "h", "w", "values", "k", "height", "width")

    def run(batches):
        for batch in batches:
            out = []
            for p in batch.itertuples():
                y, x, part = _summed(np.asarray(p.values).reshape(p.h, p.w), p.y0, p.x0, p.k, p.height * p.k, p.width * p.k)
                out.append((p.sample_id, p.channel, y, x, *part.shape, part.ravel(), p.height, p.width))
            yield pd.DataFrame(out, columns=["sample_id", "channel", "y0", "x0", "h", "w", "values", "height", "width"])

    sums = own.mapInPandas(run, "sample_id string, channel int, y0 int, x0 int, h int, w int, values array<double>, height int, width int")
    pasted = paste(cut(sums, size), size, add=True)
    if total:
        return pasted
    scale = lambda v, n: F.rint(v / n) if integer else v / n
    area = (F.col("k") * F.col("k")).cast("double").alias("_n")
    scaled = pasted.join(frame.select("sample_id", area), "sample_id")
    return scaled.withColumn("values", let(F.struct("values", "_n"), lambda s: F.transform(s["values"], lambda v: scale(v, s["_n"])))).select(*pasted.columns)


def pyramid_tiles(tiles: DataFrame, factors: Sequence[int], size: int = TILE, integer: bool = False) -> DataFrame:
    """``pixels.build_pyramid`` on blocks: the image at each factor, with its level (0 is the first factor), as blocks of ``size``.

    A level is made from the largest made before whose factor divides its own, else from the image; levels pass on
    sums, so that means are rounded once. Each level is written, and the image is read once for each factor that no other divides.
    """
    samples = materialise(tiles.select("sample_id").distinct())
    made: dict[int, DataFrame] = {}
    for f in sorted(set(factors)):
        g = max((m for m in made if f % m == 0), default=1)
        made[f] = materialise(rescale_tiles(made.get(g, tiles), samples.withColumn("k", F.lit(f // g)), size, total=True))

    def level(i: int, f: int) -> DataFrame:
        mean = lambda v: F.rint(v / (f * f)) if integer else v / (f * f)
        return made[f].withColumn("values", F.transform("values", mean)).withColumn("level", F.lit(i))

    return reduce(DataFrame.unionByName, [level(i, f) for i, f in enumerate(factors)])


# -- checks and background --------------------------------------------------------------------------------------------


def extents(tiles: DataFrame) -> DataFrame:
    """(sample_id, y, x): an image's last pixel, as ``pixels.check_shapes`` reads it."""
    return tiles.select("sample_id", (F.col("y0") + F.col("h") - 1).alias("y"), (F.col("x0") + F.col("w") - 1).alias("x"))


def check_not_blank_tiles(tiles: DataFrame) -> DataFrame:
    """Samples whose image is all zero. Blocks must be clean (``pixels.clean_tiles``)."""
    return tiles.groupBy("sample_id").agg(F.bool_and(F.forall("values", lambda v: v == 0)).alias("blank")).where("blank").select("sample_id")


def bg_mean_tiles(tiles: DataFrame) -> DataFrame:
    """``pixels.bg_mean`` on blocks: sums of blocks give the means, which are one row per sample and channel."""
    whole = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    mean = materialise(tiles.groupBy("sample_id", "channel").agg((F.sum(whole) / F.sum(F.size("values"))).alias("_mean")))
    less = let(F.struct("values", "_mean"), lambda s: F.transform(s["values"], lambda v: clip(v - s["_mean"], 0)))
    return tiles.join(mean, ["sample_id", "channel"]).withColumn("values", less).select(*tiles.columns)


def bg_af_tiles(dapi: DataFrame, af: DataFrame) -> DataFrame:
    """``pixels.bg_af`` on blocks of one grid; blocks meet, not pixels."""
    other = af.select("sample_id", "ty", "tx", F.col("values").alias("_af"))
    less = F.zip_with("values", "_af", lambda v, a: clip(v - a, 0))
    return dapi.join(other, ["sample_id", "ty", "tx"]).withColumn("values", less).select(*dapi.columns)


def histogram_tiles(tiles: DataFrame, bins: int = 256, integer: bool = False) -> DataFrame:
    """``pixels.intensity_histogram`` of blocks: pixels are counted where their block is; ranges and counts are shuffled."""
    if integer:
        return pixels.intensity_histogram(pixels.to_pixels(tiles), bins, True)
    ends = materialise(tiles.groupBy("sample_id").agg(F.min(F.array_min("values")).alias("_low"), F.max(F.array_max("values")).alias("_high")))
    return pixels.binned(pixels.to_pixels(tiles.join(ends, "sample_id")), bins)


def binarise_tiles(tiles: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``pixels.binarise`` on blocks; thresholds are one row per sample."""
    two = let(F.struct("values", "adjusted"), lambda s: F.transform(s["values"], lambda v: F.when(v > s["adjusted"], 255).otherwise(0)))
    return tiles.join(thresholds.select("sample_id", "adjusted"), "sample_id").withColumn("values", two).select(*tiles.columns)


# -- masks and overlays -----------------------------------------------------------------------------------------------


def paint(frames: DataFrame, pieces: DataFrame, size: int = TILE) -> DataFrame:
    """Mask blocks: on each block of ``frames`` the labels of its ``pieces`` (sample_id, ty, tx, at, label: arrays), else 0.

    ``at``: places in the block, row by row as if it were ``size`` wide. The smallest label of a place counts. Pieces without a block
    are left out.
    """
    names = ["sample_id", "channel", *BLOCK]

    def run(key: tuple, frame: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:
            return pd.DataFrame(columns=names)
        sample, ty, tx = key
        h, w = int(frame.h.iloc[0]), int(frame.w.iloc[0])
        area = np.full(size * size, np.iinfo(np.int32).max, np.int32)
        for p in parts.itertuples():
            np.minimum.at(area, np.asarray(p.at), np.asarray(p.label).astype(np.int32))
        area[area == np.iinfo(np.int32).max] = 0
        return pd.DataFrame([(sample, 0, ty, tx, ty * size, tx * size, h, w, area.reshape(size, size)[:h, :w].ravel())], columns=names)

    by = ["sample_id", "ty", "tx"]
    schema = "sample_id string, channel int, ty int, tx int, y0 int, x0 int, h int, w int, values array<int>"
    return frames.select(*by, "h", "w").groupBy(*by).cogroup(pieces.groupBy(*by)).applyInPandas(run, schema)


def pieces_of(cells: DataFrame, size: int = TILE) -> DataFrame:
    """Cell pixels (sample_id, y, x, cell_id) as pieces for ``paint``."""
    ty, tx = (F.floor(F.col(c) / size).cast("int") for c in ("y", "x"))
    at = ((F.col("y") % size) * size + F.col("x") % size).cast("int")
    each = cells.where("cell_id > 0").groupBy("sample_id", ty.alias("ty"), tx.alias("tx")).agg(F.collect_list(F.struct(at.alias("at"), F.col("cell_id").cast("long").alias("label"))).alias("p"))
    return each.select("sample_id", "ty", "tx", F.col("p.at").alias("at"), F.col("p.label").alias("label"))


def bw_overlay_tiles(image: DataFrame, boundary: DataFrame) -> DataFrame:
    """``pixels.bw_overlay`` on blocks: channel 0 is the image, channel 1 the boundary as 0 and 255; no shuffle."""
    names = ["sample_id", "channel", *BLOCK]
    real = lambda df, i, v: df.withColumns({"channel": F.lit(i), "values": v}).select(*names)
    lines = F.transform("values", lambda v: F.when(v > 0, 255.0).otherwise(0.0))
    return real(image, 0, F.col("values").cast("array<double>")).unionByName(real(boundary, 1, lines))


def rgb_overlay_tiles(image: DataFrame, boundary: DataFrame, limits: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``pixels.rgb_overlay`` on blocks of one grid, with values in arrays r, g and b; blocks meet, not pixels."""
    ends = materialise((limits or pixels.overlay_limits)(pixels.to_pixels(image)))
    lines = boundary.select("sample_id", "ty", "tx", F.transform("values", lambda v: F.when(v > 0, 255).otherwise(0)).alias("r"))
    both = image.join(ends, "sample_id").join(lines, ["sample_id", "ty", "tx"])

    def blue(s: Column) -> Column:
        low, high = F.get(s["q"], F.lit(0)), F.get(s["q"], F.lit(1))
        return F.transform(s["values"], lambda v: clip(F.try_divide(v - low, high - low) * 255, 0, 255).cast("int"))

    own = both.withColumn("b", let(F.struct("values", "q"), blue)).withColumn("g", F.transform("r", lambda _: F.lit(0)))
    return own.select("sample_id", "ty", "tx", "y0", "x0", "h", "w", "r", "g", "b")
