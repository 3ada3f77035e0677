"""Cell quantification: intensities, shape, and the cell x feature table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissuemill.functions.scalar import let

CELL = ["sample_id", "cell_id"]


def join_by_sample(a: DataFrame, b: DataFrame, on: Sequence[str] = ("sample_id",)) -> DataFrame:
    return a.join(b, list(on), "inner")


def combine_mask_image(mask: DataFrame, tiles: DataFrame) -> DataFrame:
    """Mask blocks (with seg) with image blocks of the same place, all pairs; the mask's values are ``labels``."""
    labels = mask.select("sample_id", "seg", "ty", "tx", F.col("values").alias("labels"))
    return tiles.join(labels, ["sample_id", "ty", "tx"])


def pair_images(nuclear: DataFrame, membrane: DataFrame, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Nuclear images with their sample's membrane image where there is one."""
    return nuclear.join(membrane, list(keys), "left")


def cell_intensity(tiles: DataFrame, mask: DataFrame, stat: str = "mean") -> DataFrame:
    """(sample_id, cell_id, channel, value): mean or sum of a channel over each cell's pixels.

    Blocks meet their mask block (same grid) as arrays; background goes before anything is shuffled by cell, and partial
    sums of each task are what is shuffled.
    """
    if stat not in ("mean", "sum"):
        raise ValueError("stat is mean or sum")
    both = tiles.join(mask.select("sample_id", "ty", "tx", F.col("values").alias("labels")), ["sample_id", "ty", "tx"])
    pixels = both.select("sample_id", "channel", F.inline(F.arrays_zip(F.col("labels").alias("cell_id"), F.col("values").alias("value"))))
    value = F.avg("value") if stat == "mean" else F.sum("value")
    return pixels.where("cell_id > 0").groupBy(*CELL, "channel").agg(value.alias("value"))


def cell_morphology(mask: DataFrame) -> DataFrame:
    """Area, centroid, extent, axes, eccentricity and orientation of each cell from its pixels' moments; one aggregate."""
    m = mask.where("cell_id > 0").groupBy(*CELL).agg(
        F.count("*").cast("double").alias("Area"), F.avg("x").alias("X_centroid"), F.avg("y").alias("Y_centroid"),
        F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"), F.covar_pop("x", "y").alias("cxy"),
        ((F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1)).alias("box"),
    )
    half, root = (F.col("vx") + F.col("vy")) / 2, F.sqrt(F.pow((F.col("vx") - F.col("vy")) / 2, F.lit(2)) + F.pow("cxy", F.lit(2)))
    m = m.withColumns({"l1": half + root, "l2": F.greatest(half - root, F.lit(0.0))})
    tie = F.when(F.col("cxy") < 0, -np.pi / 4).otherwise(np.pi / 4)
    turn = F.when((F.col("vx") == F.col("vy")), tie).otherwise(0.5 * F.atan2(2 * F.col("cxy"), F.col("vy") - F.col("vx")))
    return m.select(
        *CELL, "X_centroid", "Y_centroid", "Area", (4 * F.sqrt("l1")).alias("MajorAxisLength"), (4 * F.sqrt("l2")).alias("MinorAxisLength"),
        F.when(F.col("l1") == 0, 0.0).otherwise(F.sqrt(1 - F.col("l2") / F.col("l1"))).alias("Eccentricity"),
        (F.col("Area") / F.col("box")).alias("Extent"), turn.alias("Orientation"),
    )


def _chain(rows: Column, side: Callable[[Column], Column]) -> Column:
    """The outer chain of a cell's rows (y, low, high in order of y) on one side, from corner to corner: (y, x) of the hull.

    ``side`` is how far a row reaches. The chain so far is convex, so that a new corner takes away its last members only:
    those behind which it doesn't turn inwards.
    """
    corner = lambda row, up: F.struct((row["y"] + up).cast("double").alias("y"), side(row).cast("double").alias("x"))
    corners = F.flatten(F.transform(rows, lambda row: F.array(corner(row, -0.5), corner(row, 0.5))))

    def turns_in(a: Column, b: Column, p: Column) -> Column:
        return (b["y"] - a["y"]) * (p["x"] - b["x"]) - (b["x"] - a["x"]) * (p["y"] - b["y"]) < 0

    def add(chain: Column, p: Column) -> Column:
        held = F.filter(F.sequence(F.lit(1), F.size(chain) - 1, F.lit(1)), lambda i: turns_in(F.get(chain, i - 1), F.get(chain, i), p))
        kept = F.when(F.size(chain) < 2, chain).otherwise(F.slice(chain, 1, F.size(held) + 1))
        return F.concat(kept, F.array(p))

    return F.aggregate(corners, F.array().cast("array<struct<y:double,x:double>>"), add)


def _below(chain: Column) -> Column:
    """The area between a chain and x = 0."""
    pairs = F.zip_with(F.slice(chain, 1, F.size(chain) - 1), F.slice(chain, 2, F.size(chain) - 1), lambda a, b: (b["y"] - a["y"]) * (a["x"] + b["x"]) / 2)
    return F.aggregate(pairs, F.lit(0.0), lambda s, t: s + t)


def cell_solidity(mask: DataFrame) -> DataFrame:
    """(sample_id, cell_id, Solidity): area over convex-hull area (of the pixels as unit squares).

    A cell's rows are first shrunk to their ends; the hull's two sides are folds over them, in SQL alone. What is gathered
    is one cell's rows: as many as it is high.
    """
    rows = mask.where("cell_id > 0").groupBy(*CELL, "y").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n"))
    cells = rows.groupBy(*CELL).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("y", "low", "high"))).alias("rows"))
    chain = lambda side: let(F.col("rows"), lambda r: _chain(r, side))
    hull = cells.select(*CELL, "n", chain(lambda r: r["high"] + 0.5).alias("right"), chain(lambda r: 0.5 - r["low"]).alias("left"))
    return hull.select(*CELL, (F.col("n") / (let(F.col("right"), _below) + let(F.col("left"), _below))).alias("Solidity"))


def cell_table(intensity: DataFrame, morphology: DataFrame, markers: Sequence[str], solidity: DataFrame | None = None) -> DataFrame:
    """A column for each marker and the cell's shape; ``intensity`` has (sample_id, cell_id, marker, value)."""
    wide = intensity.groupBy(*CELL).pivot("marker", list(markers)).agg(F.first("value"))
    out = wide.join(morphology, CELL)
    return out if solidity is None else out.join(solidity, CELL)
