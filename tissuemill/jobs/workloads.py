"""The three workloads as jobs: images to cell tables, cell tables to quality tables, cell tables to clusters and maps.

Jobs check their own arguments, read tables and publish tables below an output folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuemill.functions import scalar
from tissuemill.functions.storage import materialise
from tissuemill.operators import blocks, cluster, halo, meta, pixels, quantify, report
from tissuemill.sources import manifest as sheets
from tissuemill.sources.cells import read_cells, write_partitioned

BACKGROUNDS = ("none", "mean", "gaussian", "rollingball", "af")


def processed_nuclei(tiles: DataFrame, channels: DataFrame, background: str = "none", size: float = 50, leniency: float = 0.0, block: int = 512, integer: bool = False) -> dict[str, DataFrame]:
    """The nuclear channel of every sample less its background, above its own threshold, on blocks of one grid; by name.

    image: blocks of 0 and 255; thresholds: a row a sample; histogram: of the image before the threshold. ``integer`` images are
    counted by value as long as the background leaves them whole (none, af).
    """
    if background not in BACKGROUNDS:
        raise ValueError(f"background is one of {', '.join(BACKGROUNDS)}")
    if not -1 <= leniency <= 1:
        raise ValueError("leniency lies between -1 and 1")
    nuclei = pixels.clean_tiles(meta.extract_channel(tiles, channels))  # first: a filter would spread what isn't finite
    _refuse(blocks.check_not_blank_tiles(nuclei), "a blank nuclear channel")
    if background == "gaussian":
        nuclei = halo.bg_gaussian(nuclei, size, block)
    elif background == "rollingball":
        nuclei = halo.bg_rollingball(nuclei, int(size), block)
    elif background == "mean":
        nuclei = blocks.bg_mean_tiles(nuclei)
    elif background == "af":
        af = pixels.clean_tiles(meta.extract_channel(tiles, channels, "AF"))
        _refuse(pixels.check_shapes(blocks.extents(nuclei), blocks.extents(af)), "a nuclear and an autofluorescence channel of different sizes")
        nuclei = blocks.bg_af_tiles(nuclei, af)
    nuclei = materialise(nuclei)  # the range, the histogram and the threshold read it
    if background == "af":
        _refuse(blocks.check_not_blank_tiles(nuclei), "nothing is left of a nuclear channel without autofluorescence")
    histogram = materialise(blocks.histogram_tiles(nuclei, integer=integer and background in ("none", "af")))
    thresholds = materialise(pixels.otsu_of(histogram, leniency))
    return {"image": blocks.binarise_tiles(nuclei, thresholds), "thresholds": thresholds, "histogram": histogram}


def binarised_nuclei(tiles: DataFrame, channels: DataFrame, background: str = "none", size: float = 50, leniency: float = 0.0, block: int = 512, integer: bool = False) -> DataFrame:
    """The image of ``processed_nuclei`` as pixels."""
    return pixels.to_pixels(processed_nuclei(tiles, channels, background, size, leniency, block, integer)["image"])


def _refuse(found: DataFrame, what: str) -> None:
    """Raise an error that names the first samples of ``found``, if there are any."""
    rows = found.select("sample_id").orderBy("sample_id").limit(10).collect()
    if rows:
        raise ValueError(f"{what}: {', '.join(str(r[0]) for r in rows)}")


def images_to_cells(tiles: DataFrame, mask: DataFrame, channels: DataFrame, markers: DataFrame, stat: str = "mean", solidity: bool = True) -> DataFrame:
    """The cell x feature table of all samples from image blocks and mask blocks on one grid.

    Marker names of the pivot come from the marker sheet, which is small. Pixels are met as blocks; what is shuffled by
    cell are partial sums.
    """
    picked = meta.match_channels(channels, markers).where("channel is not null").select("sample_id", "channel", F.col("marker_name").alias("marker"))
    names = [r["marker_name"] for r in markers.orderBy("marker_idx").collect()]
    values = quantify.cell_intensity(tiles, mask, stat).join(picked, ["sample_id", "channel"]).select("sample_id", "cell_id", "marker", "value")
    labels = pixels.to_pixels(mask, "cell_id").select("sample_id", F.lit(0).alias("plane"), "y", "x", "cell_id")
    return quantify.cell_table(values, quantify.cell_morphology(labels), names, quantify.cell_solidity(labels) if solidity else None)


Segmenter = Callable[[DataFrame, DataFrame | None], DataFrame]


def sheets_to_cells(manifest: DataFrame, images: DataFrame, levels: DataFrame, channels: DataFrame, markers: DataFrame, segmenter: Segmenter | dict[str, Segmenter],
                    regions: DataFrame | None = None, membrane: str | None = None, background: str | None = None, size: float = 50, leniency: float = 0.0,
                    target: float = 1.0, stat: str = "mean", solidity: bool = True, integer: bool = False, block: int = 512) -> dict[str, DataFrame]:
    """From sheets and images of all samples to the cell table and what else the image job publishes, by name.

    ``images``: blocks with path and level (fields of a ``tiles`` sample: level 0, each field from its own corner, placed by
    ``regions``); ``levels``: axes, shape and physical size of each level. Sheets that break a rule, samples without a usable
    level or nuclear channel, blank images and other bad input are refused before cells are made. Each sample is scaled to
    ``target`` um a pixel from its best level. ``background``: segment the thresholded nuclear channel, less that background;
    None: the channel itself. ``segmenter`` gets blocks of that nuclear image and of the membrane channel (None without one) and
    returns mask blocks (``halo.segment_tiles``) or cell pixels (sample_id, y, x, cell_id); several are given by the name of
    their segmentation, seg. Intensities come from the scaled image, overlays show the image that was segmented.

    Returned: cells (by sample and seg), mask, bw_overlay and rgb_overlay (blocks, by seg), selected (the image's blocks of the sheet's
    channels, renumbered), scale_metadata; with a background also thresholds and histogram. Images stay blocks from end to end: what
    is shuffled of them are arrays, of cells only partial sums.
    """
    for bad in (sheets.validate_manifest(manifest), sheets.validate_markers(markers)):
        _refuse(bad.select(F.concat_ws(": ", F.col("row").cast("string"), "message").alias("sample_id")), "a sheet breaks the rules")
    _refuse(sheets.check_single_file(manifest), "a stitched or fused sample needs one file")
    analysed = meta.analyze_levels(levels.join(manifest.select("sample_id").distinct(), "sample_id", "left_semi"), target)
    chosen = materialise(meta.select_level(analysed))
    _refuse(chosen.where("message is not null"), "no level to read")
    routes = {form: images.join(rows.select("sample_id").distinct(), "sample_id", "left_semi") for form, rows in sheets.branch_by_format(manifest).items()}
    plain = [routes[f].join(chosen.select("sample_id", "level"), ["sample_id", "level"], "left_semi") for f in ("stitched", "fused")]
    if regions is not None:
        plain.append(blocks.stitch_tiles(routes["tiles"].drop("level"), regions, block))
    else:
        _refuse(routes["tiles"].select("sample_id").distinct(), "fields of a sample need their positions")
    image = sheets.union_images(*[part.select("sample_id", F.col("channel").cast("int").alias("channel"), *blocks.BLOCK) for part in plain])
    tiles = materialise(blocks.rescale_tiles(image, chosen, block, integer))
    _refuse(meta.channel_violations(channels, tiles.groupBy("sample_id").agg((F.max("channel") + 1).alias("n_channels"))), "no nuclear channel")
    out: dict[str, DataFrame] = {}
    if background is None:
        seen = meta.extract_channel(tiles, channels)
    else:
        found = processed_nuclei(tiles, channels, background, size, leniency, block, integer)
        seen = materialise(found.pop("image"))
        out |= found
    seconds = meta.extract_channel(tiles, channels, membrane) if membrane else None
    named = segmenter if isinstance(segmenter, dict) else {"all": segmenter}
    masks = []
    for seg, run in named.items():
        labels = run(seen, seconds)
        if "values" not in labels.columns:
            labels = blocks.paint(seen, blocks.pieces_of(labels, block), block)
        masks.append(labels.select("sample_id", "channel", *blocks.BLOCK).withColumn("seg", F.lit(seg)))
    mask = materialise(reduce(DataFrame.unionByName, masks))
    parts: dict[str, list[DataFrame]] = {"cells": [], "bw_overlay": [], "rgb_overlay": []}
    for seg in named:
        own = mask.where(F.col("seg") == seg).drop("seg")
        lines = materialise(halo.boundary_tiles(own, block))
        parts["cells"].append(images_to_cells(tiles, own, channels, markers, stat, solidity).withColumn("seg", F.lit(seg)))
        parts["bw_overlay"].append(blocks.bw_overlay_tiles(seen, lines).withColumn("seg", F.lit(seg)))
        parts["rgb_overlay"].append(blocks.rgb_overlay_tiles(seen, lines).withColumn("seg", F.lit(seg)))
    out |= {name: reduce(DataFrame.unionByName, each) for name, each in parts.items()}
    return out | {"mask": mask, "selected": meta.select_channels(tiles, channels, markers), "scale_metadata": _scaling(analysed, chosen, tiles, channels, manifest, target)}


def _scaling(analysed: DataFrame, chosen: DataFrame, tiles: DataFrame, channels: DataFrame, manifest: DataFrame, target: float) -> DataFrame:
    """(sample_id, json): how each image was scaled, from which files, to which shape."""
    first = analysed.where("level = 0").select("sample_id", F.col("physical_size_x").alias("original_physical_size_x"))
    level = analysed.join(chosen.select("sample_id", "level"), ["sample_id", "level"]).select("sample_id", F.col("level").alias("pyramid_level_used"), F.col("scale").alias("pyramid_scale_factor"), F.col("k").cast("int").alias("integer_scale_applied"), F.col("final").alias("final_physical_size_x"), F.col("final").alias("final_physical_size_y"), F.col("axes").alias("original_axes"))
    shape = tiles.groupBy("sample_id").agg(F.array(F.max("channel") + 1, F.max(F.col("y0") + F.col("h")), F.max(F.col("x0") + F.col("w"))).alias("output_shape"))
    names = channels.groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("channel", "name"))), lambda c: c["name"]).alias("channel_names"))
    files = manifest.groupBy("sample_id").agg(F.array_sort(F.collect_list("path")).alias("original_files"))
    every = files.join(first, "sample_id").join(level, "sample_id").join(shape, "sample_id").join(names, "sample_id", "left")
    every = every.withColumns({"target_micron_per_pixel": F.lit(float(target)), "output_axes": F.lit("CYX")})
    return meta.scale_metadata_json(every, [c for c in every.columns if c != "sample_id"])


def report_cells(spark: SparkSession, path: str, markers: DataFrame, sample_id: str) -> tuple[DataFrame, list[str], DataFrame]:
    """A sample's cell CSV as the report wants it: cells with unique ids, the sheet's markers among its columns, and those missing."""
    raw = read_cells(spark, path, sample_id)
    own = markers.withColumn("marker_name", scalar.make_names(F.col("marker_name")))  # as the columns' names are made
    return report.make_unique(raw, "row_id"), report.effective_markers(own, raw.columns), report.missing_markers(own, raw.columns)


def report_tables(spark: SparkSession, files: DataFrame, markers: DataFrame, folder: str | None = None, points: int = 512, sample: int = 100_000) -> dict[str, DataFrame]:
    """The quality tables of many cell CSVs in one job (``files``: sample_id, seg, path), published below ``folder`` if given.

    Samples of a segmentation are reported together, by sample; all files must have the same markers of the sheet. Tables
    have sample_id and seg.
    """
    rows = files.select("sample_id", "seg", "path").orderBy("sample_id", "seg").collect()  # the list of files, a row a CSV
    parts: dict[str, list[DataFrame]] = {}
    shown: dict[str, list[str]] = {}
    for r in rows:
        cells, found, _ = report_cells(spark, r["path"], markers, r["sample_id"])
        parts.setdefault(r["seg"], []).append(cells)
        if shown.setdefault(r["seg"], found) != found:
            raise ValueError(f"{r['path']} has other markers of the sheet than the files before it")
    every: dict[str, list[DataFrame]] = {}
    for seg, cells in parts.items():
        for name, table in quality_tables(materialise(reduce(DataFrame.unionByName, cells)), shown[seg], points, sample).items():
            every.setdefault(name, []).append(table.withColumn("seg", F.lit(seg)))
    tables = {name: reduce(DataFrame.unionByName, each) for name, each in every.items()}
    if folder is not None:
        publish(tables, folder)
    return tables


def quality_tables(cells: DataFrame, markers: Sequence[str], points: int = 512, sample: int = 100_000) -> dict[str, DataFrame]:
    """The tables of the quality report, by name. Extreme cells are left out of all but the table that lists them."""
    if not markers:
        raise ValueError("no marker of the sheet is a column of the data")
    everything = report.to_long(cells, markers)
    extreme = materialise(report.flag_extreme_cells(everything))
    cells, long = report.drop_cells(cells, extreme), report.drop_cells(everything, extreme)
    logged = materialise(report.clr(long))
    sampled = report.sample_cells(logged, sample)
    shape = [c for c in ("Area", "Eccentricity", "Solidity", "Extent") if c in cells.columns]
    by = ["sample_id", "marker"]
    tables = {
        "extreme_cells": extreme,
        "area_summary": report.area_summary(cells),
        "marker_summary": report.marker_summary(logged),
        "marker_summary_clr": report.marker_summary(logged, "clr"),
        "shape_density": report.density(report.to_long(cells, shape), by, points=points),
        "intensity_density": report.density(logged, by, points=points),
        "clr_density": report.density(logged, by, "clr", points),
        "box": report.box_stats(logged), "box_clr": report.box_stats(logged, "clr"),
        "correlation": report.correlation_matrix(cells, markers),
        "qq": report.qq_points(sampled), "qq_clr": report.qq_points(sampled, "clr"),
        "qq_line": report.qq_line(sampled), "qq_line_clr": report.qq_line(sampled, "clr"),
    }
    return tables


def cluster_tables(cells: DataFrame, markers: Sequence[str], resolutions: Sequence[float] = cluster.RESOLUTIONS, k: int = 20, components: int = 6, limit: int = 100_000, sketch: int = 50_000) -> dict[str, DataFrame]:
    """Clusters of all cells at all resolutions, with the tables behind their maps. Ids must be unique (``make_unique``).

    Samples of up to ``limit`` cells are clustered whole, whatever others are in the run. In each larger sample clusters and map
    are found on a leverage sketch of ``sketch`` cells, and its other cells take labels and positions from their nearest sketch cells.
    """
    own = report.marker_columns(list(markers))
    features = materialise(cluster.scale_features(cluster.clr_normalise(cluster.to_features(cells, own))))
    large = materialise(cluster.samples_over(features, limit))
    part = cluster.leverage_sample(features.join(large, "sample_id", "left_semi"), sketch)
    drawn = materialise(features.join(large, "sample_id", "left_anti").unionByName(cluster.scale_features(part)))
    axes = materialise(cluster.principal_axes(drawn, components))
    points = materialise(cluster.project(drawn, axes))
    near = materialise(cluster.knn(points, k))
    labels = materialise(cluster.clusters(cluster.snn(near, k), resolutions, points))
    layout = materialise(cluster.layout_2d(cluster.fuzzy_graph(near, k)))
    if not large.isEmpty():
        full = materialise(cluster.project(features, axes))
        labels = materialise(cluster.labels_of_all(points, labels, full, k, limit))
        layout = materialise(cluster.layout_of_all(points, layout, full, k, limit))
    long = features.select("sample_id", "cell_id", F.posexplode("v").alias("i", "value")).select("sample_id", "cell_id", F.get(F.array(*map(F.lit, own)), F.col("i")).alias("marker"), "value")
    return {
        "clusters": labels,
        "layout": layout,
        "cluster_labels": cluster.cluster_labels_2d(layout, labels),
        "marker_means": cluster.cluster_marker_means(long, labels),
        "marker_density": cluster.cluster_marker_density(long, labels),
        "spatial_map": cluster.spatial_map(cells, labels),
        "spatial_markers": cluster.spatial_marker_map(cells, markers),
    }


def publish(tables: dict[str, DataFrame], folder: str, seg: str = "all") -> None:
    """Write each table below ``folder``, by sample and segmentation (its own, where it has a seg)."""
    for name, df in tables.items():
        write_partitioned(df if "seg" in df.columns else df.withColumn("seg", F.lit(seg)), f"{folder.rstrip('/')}/{name}")
