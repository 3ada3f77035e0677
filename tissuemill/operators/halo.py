"""Neighbourhood filters on blocks: each block gets strips of its neighbours, a numpy helper runs on it, the rim is cut off."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.scalar import let
from tissuemill.functions.storage import materialise
from tissuemill.operators.blocks import crop, paint
from tissuemill.operators.pixels import to_pixels

BLOCK = "sample_id string, channel int, ty int, tx int, y0 int, x0 int, h int, w int, values array<double>"


def halo_parts(tiles: DataFrame, halo: int, size: int = 512) -> DataFrame:
    """What is sent for ``map_halo_tiles``: (sample_id, channel, gy, gx, own, y0, x0, h, w, values).

    Every block goes whole to itself (own) and as strips to its neighbours: to each the rows and columns that lie within ``halo``
    pixels of it, cut out as arrays before anything is shuffled. With halo <= size that is at most
    1 + 4 * halo / size + 4 * (halo / size)^2 values for each value of a full block. No strip goes to rows or columns before the first; those sent
    beyond the last block find none there and are dropped.
    """
    reach = -(-halo // size)
    h, w = F.col("h"), F.col("w")

    def strip(a: int, b: int) -> Column:
        top, left = max(0, a * size - halo), max(0, b * size - halo)
        rows, cols = F.least(h, F.lit((a + 1) * size + halo)) - top, F.least(w, F.lit((b + 1) * size + halo)) - left
        gy, gx = F.col("ty") + a, F.col("tx") + b
        values = F.col("values") if a == b == 0 else crop(F.col("values"), h, w, F.lit(top), F.lit(left), rows, cols)
        sent = F.struct(gy.cast("int").alias("gy"), gx.cast("int").alias("gx"), F.lit(a == b == 0).alias("own"), (F.col("y0") + top).cast("int").alias("y0"), (F.col("x0") + left).cast("int").alias("x0"), rows.cast("int").alias("h"), cols.cast("int").alias("w"), values.alias("values"))
        return F.when((gy >= 0) & (gx >= 0) & (rows > 0) & (cols > 0), sent)

    around = range(-reach, reach + 1)
    strips = F.array_compact(F.array(*[strip(a, b) for a in around for b in around]))
    return tiles.select("sample_id", F.col("channel").cast("int").alias("channel"), F.inline(strips))


def map_halo_tiles(tiles: DataFrame, fn: Callable[[np.ndarray], np.ndarray], halo: int, size: int = 512, schema: str = BLOCK, whole: Callable | None = None) -> DataFrame:
    """``fn`` on every block extended by ``halo`` pixels (fewer at the image's edges), cut back to the block.

    Blocks lie on a grid of ``size``, their corners on its lines. See ``halo_parts`` for what is shuffled. ``whole``
    replaces the cutting back: it gets the key, the extended array and the block's place in it, and returns rows. Blocks whose
    values hold several layers, one after the other, come as (layers, h, w); where some have fewer, the last are 0.
    """

    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        sample, channel, ty, tx = key
        own = parts[parts.own]
        if own.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        h, w = int(own.h.iloc[0]), int(own.w.iloc[0])
        top, left = max(0, ty * size - halo), max(0, tx * size - halo)
        bottom = min(ty * size + h + halo, int((parts.y0 + parts.h).max()))
        right = min(tx * size + w + halo, int((parts.x0 + parts.w).max()))
        layers = max(len(p.values) // (p.h * p.w) for p in parts.itertuples())
        area = np.zeros((layers, bottom - top, right - left))
        for p in parts.itertuples():
            block = np.asarray(p.values, float).reshape(-1, p.h, p.w)[:, : bottom - p.y0, : right - p.x0]
            area[: len(block), p.y0 - top : p.y0 - top + block.shape[1], p.x0 - left : p.x0 - left + block.shape[2]] = block
        area = area[0] if layers == 1 else area
        inner = (slice(ty * size - top, ty * size - top + h), slice(tx * size - left, tx * size - left + w))
        if whole is not None:
            return whole(key, area, (top, left), inner)
        out = fn(area)[inner]
        return pd.DataFrame([(sample, channel, ty, tx, ty * size, tx * size, h, w, out.ravel())], columns=["sample_id", "channel", "ty", "tx", "y0", "x0", "h", "w", "values"])

    return halo_parts(tiles, halo, size).groupBy("sample_id", "channel", "gy", "gx").applyInPandas(run, schema)


def gaussian(image: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian blur, cut off at four sigma, edges repeated; one axis after the other."""
    radius = int(4 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        wide = np.pad(image, [(radius, radius) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        out = np.zeros_like(image)
        for k, weight in enumerate(kernel):
            out += weight * (wide[k : k + image.shape[0]] if axis == 0 else wide[:, k : k + image.shape[1]])
        image = out
    return image


def ball_background(image: np.ndarray, radius: int) -> np.ndarray:
    """The surface that a ball of ``radius`` reaches when it rolls below the image: least of value plus depth of the ball."""
    r = int(radius)
    wide = np.pad(image, r, constant_values=np.inf)
    out = np.full(image.shape, np.inf)
    for dy in range(-r, r + 1):
        for dx in range(-r, r + 1):
            d = dy * dy + dx * dx
            if d <= r * r:
                part = wide[r + dy : r + dy + image.shape[0], r + dx : r + dx + image.shape[1]]
                np.minimum(out, part + (r - np.sqrt(r * r - d)), out=out)
    return out


def bg_gaussian(tiles: DataFrame, sigma: float = 50, size: int = 512) -> DataFrame:
    """Blocks less their Gaussian background, at least 0."""
    return map_halo_tiles(tiles, lambda v: np.clip(v - gaussian(v, sigma), 0, None), int(4 * sigma + 0.5), size)


def bg_rollingball(tiles: DataFrame, radius: int = 50, size: int = 512) -> DataFrame:
    """Blocks less their rolling-ball background, at least 0."""
    return map_halo_tiles(tiles, lambda v: np.clip(v - ball_background(v, radius), 0, None), radius, size)


def outer_edges(labels: np.ndarray) -> np.ndarray:
    """255 on outer boundaries of a label array, else 0; see ``pixels.outer_boundaries``. Beyond the array nothing counts."""
    h, w = labels.shape
    wide = np.pad(labels, 1, mode="edge")  # repeats pixels that are neighbours already
    around = np.stack([wide[a : a + h, b : b + w] for a in range(3) for b in range(3)])
    four = around[[1, 3, 4, 5, 7]]
    least = np.where(around == 0, np.inf, around).min(0)
    edge = (four.min(0) != four.max(0)) & ((labels == 0) | (least != around.max(0)))
    return np.where(edge, 255.0, 0.0)


def boundary_tiles(mask: DataFrame, size: int = 512) -> DataFrame:
    """``pixels.outer_boundaries`` on blocks of a mask: a block's rows and columns at its edges are shuffled beside itself."""
    return map_halo_tiles(mask, outer_edges, 1, size)


def segment_tiles(tiles: DataFrame, predict: Callable[[np.ndarray], np.ndarray], halo: int, size: int = 512, membrane: DataFrame | None = None) -> DataFrame:
    """Mask blocks on the image's grid: a user's segmenter, run once on every extended block of one-channel images.

    ``predict`` gets a 2-D array and returns labels (0: background). With ``membrane``, blocks of a second channel on the same
    grid, samples that have one give (2, h, w) arrays, the nuclear channel first; the others stay 2-D. A cell belongs to the block that holds its centroid,
    so cells that a block's edge cuts come out once; halo must be at least a cell's extent. Where cells of two blocks overlap
    the smaller id counts. Ids are made unique per sample by numbering the blocks: counts of each block, summed before it.
    Cells are sent to the blocks that they reach into as arrays of places.
    """
    names = ["sample_id", "oy", "ox", "ty", "tx", "at", "label"]

    def own_cells(key: tuple, area: np.ndarray, corner: tuple[int, int], inner: tuple[slice, slice]) -> pd.DataFrame:
        labels = predict(area)
        ys, xs = np.nonzero(labels)
        found = pd.DataFrame({"y": ys, "x": xs, "local": labels[ys, xs].astype("int64")})
        if found.empty:
            return pd.DataFrame(columns=names)
        centre = found.groupby("local")[["y", "x"]].transform("mean")
        found = found[(centre.y >= inner[0].start) & (centre.y < inner[0].stop) & (centre.x >= inner[1].start) & (centre.x < inner[1].stop)]
        y, x = found.y + corner[0], found.x + corner[1]
        placed = pd.DataFrame({"ty": y // size, "tx": x // size, "at": (y % size) * size + x % size, "local": found.local})
        rows = [(key[0], key[2], key[3], ty, tx, g["at"].to_numpy(), g["local"].to_numpy()) for (ty, tx), g in placed.groupby(["ty", "tx"])]
        return pd.DataFrame(rows, columns=names)

    frames = tiles.select("sample_id", "ty", "tx", "h", "w")
    if membrane is not None:
        other = membrane.select("sample_id", "ty", "tx", F.col("values").alias("_more"))
        both = F.concat("values", F.coalesce("_more", F.array().cast(dict(tiles.dtypes)["values"])))
        tiles = tiles.join(other, ["sample_id", "ty", "tx"], "left").withColumn("values", both).drop("_more")
    cells = materialise(map_halo_tiles(tiles, lambda v: v, halo, size, "sample_id string, oy int, ox int, ty int, tx int, at array<int>, label array<long>", own_cells))
    blocks = cells.groupBy("sample_id", "oy", "ox").agg(F.max(F.array_max("label")).alias("most"))
    before = F.sum("most").over(Window.partitionBy("sample_id").orderBy("oy", "ox").rowsBetween(Window.unboundedPreceding, -1))  # a row a block
    blocks = blocks.select("sample_id", "oy", "ox", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = let(F.struct("label", "_before"), lambda s: F.transform(s["label"], lambda x: x + s["_before"]))
    return paint(frames, cells.join(blocks, ["sample_id", "oy", "ox"]).select("sample_id", "ty", "tx", "at", numbered.alias("label")), size)


def segment(tiles: DataFrame, predict: Callable[[np.ndarray], np.ndarray], halo: int, size: int = 512, membrane: DataFrame | None = None) -> DataFrame:
    """(sample_id, y, x, cell_id): the cell pixels of ``segment_tiles``."""
    return to_pixels(segment_tiles(tiles, predict, halo, size, membrane), "cell_id").where("cell_id > 0").select("sample_id", "y", "x", "cell_id")
