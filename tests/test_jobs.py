import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_pixels import image, mask_frame
from tissuemill.jobs import workloads
from tissuemill.operators import halo, pixels

SF = "/root/testdata/sf0.001"
ITERATIVE = {"c6_louvain", "c8b_layout_2d", "c7_transfer_labels"}  # tests of their own hold them, on planted groups


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def one(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return "NULL"
        return f"{x + 0.0:.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", [q for q in entry.queries() if q not in ITERATIVE and not q.startswith("op") and q != "pipeline"])
def test_query_against_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    import duckdb

    con = duckdb.connect()
    for t in ("nation", "region", "supplier", "part", "lineitem", "events", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(got.fetchall(), names)


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_images_to_quality_and_cluster_tables(spark, tmp_path):
    rng = np.random.default_rng(5)
    labels = np.kron(np.arange(1, 37).reshape(6, 6), np.ones((4, 4)))
    group = (labels % 2).astype(int)
    parts = [image(spark, rng.random(labels.shape) + 4 * (group == c % 2), channel=c) for c in range(4)]
    stack = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    tiles = pixels.to_tiles(stack, 10)
    mask = pixels.to_tiles(mask_frame(spark, labels).withColumn("channel", F.lit(0)), 10, "cell_id")
    channels = spark.createDataFrame([("s", i, n) for i, n in enumerate(["dapi", "cd3", "cd8", "cd20"])], "sample_id string, channel int, name string")
    markers = spark.createDataFrame([("DAPI", 0), ("CD3", 1), ("CD8", 2), ("CD20", 3)], "marker_name string, marker_idx int")
    cells = workloads.images_to_cells(tiles, mask, channels, markers)
    assert cells.count() == 36 and {"DAPI", "CD20", "Area", "Solidity"} <= set(cells.columns)
    nuclei = workloads.binarised_nuclei(tiles, channels, "mean")
    assert {r["value"] for r in nuclei.select("value").distinct().collect()} == {0, 255}
    with pytest.raises(ValueError):
        workloads.binarised_nuclei(tiles, channels, "other")
    names = ["DAPI", "CD3", "CD8", "CD20"]
    quality = workloads.quality_tables(cells, names, points=16)
    assert quality["marker_summary"].count() == 4 and quality["shape_density"].count() == 64 and quality["qq"].count() == 144
    workloads.publish({"box": quality["box"]}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "box")).count() == 4
    found = workloads.cluster_tables(cells, names, (0.2,), k=8, components=2)
    kinds = {}
    for r in found["clusters"].collect():
        kinds.setdefault(r["cluster"], set()).add(int(group.ravel()[np.flatnonzero(labels.ravel() == r["cell_id"])[0]]))
    assert all(len(v) == 1 for v in kinds.values())
    assert found["spatial_map"].count() == 36 and found["spatial_markers"].count() == 144


@pytest.mark.parametrize("background", workloads.BACKGROUNDS)
def test_one_pixel_that_is_not_finite_counts_as_zero(spark, background):
    """A hole in the image gives what the image with a zero there gives, whatever the background's kernel."""
    rng = np.random.default_rng(3)
    plain, other = rng.random((24, 24)), rng.random((24, 24)) / 4
    plain[10, 11] = 0
    holed = plain.copy()
    holed[10, 11] = np.nan
    channels = spark.createDataFrame([("s", 0, "dapi"), ("s", 1, "AF")], "sample_id string, channel int, name string")

    def run(values):
        tiles = pixels.to_tiles(image(spark, values).union(image(spark, other, channel=1)), 10)
        found = workloads.binarised_nuclei(tiles, channels, background, size=2, block=10)
        return {(r["y"], r["x"]): r["value"] for r in found.collect()}

    assert run(holed) == run(plain)


def test_background_job_refuses_blank_and_unequal_images(spark):
    channels = spark.createDataFrame([("s", 0, "dapi"), ("s", 1, "AF")], "sample_id string, channel int, name string")
    small, large, blank = np.ones((6, 6)), np.ones((8, 6)), np.zeros((6, 6))
    for first, second, text in ((blank, small, "blank"), (small, large, "different sizes")):
        tiles = pixels.to_tiles(image(spark, first).union(image(spark, second, channel=1)), 4)
        with pytest.raises(ValueError, match=text):
            workloads.binarised_nuclei(tiles, channels, "af")


def test_sheets_to_cells(spark):
    """Fields and a whole image of one scene give one cell table; bad sheets are refused; a membrane reaches the segmenter."""
    rng = np.random.default_rng(1)
    scene, other = rng.random((24, 16)) + 1, rng.random((24, 16))
    stack = image(spark, scene).union(image(spark, other, channel=1)).drop("sample_id")
    whole = stack.withColumn("sample_id", F.lit("b")).withColumn("path", F.lit("b.tif"))
    fields = stack.withColumn("sample_id", F.lit("a")).withColumn("path", F.concat(F.lit("f"), F.floor(F.col("y") / 12).cast("string"))).withColumn("y", F.col("y") % 12)
    images = pixels.to_tiles(whole.unionByName(fields), 8, by=("sample_id", "path", "channel")).withColumn("level", F.lit(0))
    files = spark.createDataFrame([("a", "f0", "tiles"), ("a", "f1", "tiles"), ("b", "b.tif", "stitched")], "sample_id string, path string, format string")
    regions = spark.createDataFrame([("a", "f0", 3, 4), ("a", "f1", 3, 16)], "sample_id string, path string, x int, y int")
    levels = spark.createDataFrame([(s, 0, "CYX", [2, 24, 16], 0.5) for s in "ab"], "sample_id string, level int, axes string, shape array<int>, physical_size_x double")
    channels = spark.createDataFrame([(s, i, n) for s in "ab" for i, n in enumerate(["dapi", "CD3"])], "sample_id string, channel int, name string")
    markers = spark.createDataFrame([("DAPI", "x", "1", 0), ("CD3", "y", "1", 1)], "marker_name string, channel_name string, cycle_number string, marker_idx int")

    def predict(area):  # tells two layers from one; pixels are cells where both channels are high
        assert area.shape[0] == 2
        high = (area[0] > 1.5) & (area[1] > 0.4)
        return np.where(high, np.arange(1, high.size + 1).reshape(high.shape), 0)

    def run(files, **more):
        segmenter = lambda nuclei, membrane: halo.segment(nuclei, predict, 2, 8, membrane)
        return workloads.sheets_to_cells(files, images, levels, channels, markers, segmenter, membrane="CD3", block=8, **more)

    got = run(files, regions=regions, solidity=False)
    half = lambda a: a.reshape(12, 2, 8, 2).mean((1, 3))
    want = sorted((round(float(v), 6), round(float(w), 6)) for v, w in zip(half(scene).ravel(), half(other).ravel(), strict=True) if v > 1.5 and w > 0.4)
    rows = got["cells"].collect()
    for s in "ab":
        assert sorted((round(r["DAPI"], 6), round(r["CD3"], 6)) for r in rows if r["sample_id"] == s) == want
    assert pixels.to_pixels(got["bw_overlay"]).count() == 384 and got["rgb_overlay"].agg(F.sum(F.size("b"))).first()[0] == 192
    assert got["selected"].agg(F.max("channel")).first()[0] == 1
    scaling = {r["sample_id"]: json.loads(r["json"]) for r in got["scale_metadata"].collect()}
    assert scaling["a"]["original_files"] == ["f0", "f1"] and scaling["b"]["output_shape"] == [2, 12, 8] and scaling["b"]["integer_scale_applied"] == 2 and scaling["a"]["channel_names"] == ["dapi", "CD3"]
    for bad, text in ((files.withColumn("format", F.lit("odd")), "rules"), (files.withColumn("format", F.lit("fused")), "one file")):
        with pytest.raises(ValueError, match=text):
            run(bad, regions=regions)
    with pytest.raises(ValueError, match="positions"):
        run(files)


def test_report_cells_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CellID,DAPI,HLA-ABC,Area\n1,2,3,4\n1,5,6,7\n2,inf,1,1\n")
    markers = spark.createDataFrame([("DAPI", 0), ("HLA-ABC", 1), ("CD8", 2)], "marker_name string, marker_idx int")
    cells, found, missing = workloads.report_cells(spark, str(tmp_path / "a.csv"), markers, "a")
    assert sorted((r["cell_id"], r["HLA.ABC"]) for r in cells.collect()) == [("1", 3.0), ("1.1", 6.0)]
    assert found == ["DAPI", "HLA.ABC"] and [r["marker_name"] for r in missing.collect()] == ["CD8"]


def test_overlays_show_what_was_segmented_and_segmentations_stay_apart(spark, tmp_path):
    """With a background the overlays' image is the thresholded one; two segmenters give two masks and tables, published by seg."""
    rng = np.random.default_rng(6)
    scene = np.rint(rng.random((20, 24)) * 50)
    image_of = pixels.to_tiles(image(spark, scene).withColumn("path", F.lit("s.tif")), 16, by=("sample_id", "path", "channel")).withColumn("level", F.lit(0))
    files = spark.createDataFrame([("s", "s.tif", "fused")], "sample_id string, path string, format string")
    levels = spark.createDataFrame([("s", 0, "CYX", [1, 20, 24], 1.0)], "sample_id string, level int, axes string, shape array<int>, physical_size_x double")
    channels = spark.createDataFrame([("s", 0, "dapi")], "sample_id string, channel int, name string")
    markers = spark.createDataFrame([("DAPI", "x", "1", 0)], "marker_name string, channel_name string, cycle_number string, marker_idx int")
    whole = lambda n, m: n.withColumn("values", F.transform("values", lambda v: F.when(v > 0, 1).otherwise(0)))
    upper = lambda n, m: pixels.to_pixels(n).where("value > 0 and y < 10").select("sample_id", "y", "x", F.lit(7).alias("cell_id"))
    got = workloads.sheets_to_cells(files, image_of, levels, channels, markers, {"one": whole, "two": upper}, background="none", integer=True, block=8, solidity=False)
    cut = pixels.otsu(image(spark, scene), integer=True).first()["adjusted"]
    assert got["thresholds"].first()["adjusted"] == cut and got["histogram"].agg(F.sum("n")).first()[0] == scene.size
    high = scene > cut
    shown = pixels.to_pixels(got["bw_overlay"].where("seg = 'one' and channel = 0")).collect()
    assert all(r["value"] == (255.0 if high[r["y"], r["x"]] else 0.0) for r in shown) and len(shown) == scene.size
    cells = {(r["seg"], r["cell_id"]): r for r in got["cells"].collect()}
    assert set(cells) == {("one", 1), ("two", 7)} and cells["one", 1]["Area"] == high.sum() and cells["two", 7]["Area"] == high[:10].sum()
    assert abs(cells["one", 1]["DAPI"] - scene[high].mean()) < 1e-9  # of the image, not of the thresholded one
    plan = got["mask"]._jdf.queryExecution().optimizedPlan().toString() + got["bw_overlay"]._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan
    workloads.publish({"cells": got["cells"]}, str(tmp_path))
    assert {r["seg"] for r in spark.read.parquet(str(tmp_path / "cells")).select("seg").distinct().collect()} == {"one", "two"}


def test_nothing_left_of_a_nuclear_channel_is_refused(spark):
    channels = spark.createDataFrame([("s", 0, "dapi"), ("s", 1, "AF")], "sample_id string, channel int, name string")
    tiles = pixels.to_tiles(image(spark, np.ones((6, 6))).union(image(spark, np.ones((6, 6)) * 2, channel=1)), 4)
    with pytest.raises(ValueError, match="nothing is left"):
        workloads.processed_nuclei(tiles, channels, "af")


def test_report_of_many_csvs(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for s in ("a", "b"):
        for seg in ("x", "y"):
            path = tmp_path / f"{s}_{seg}.csv"
            path.write_text("CellID,DAPI,CD8,Area\n" + "".join(f"{i},{rng.random():.6f},{rng.random():.6f},{i + 1}\n" for i in range(30 if seg == "x" else 20)))
            rows.append((s, seg, str(path)))
    files = spark.createDataFrame(rows, "sample_id string, seg string, path string")
    markers = spark.createDataFrame([("DAPI", 0), ("CD8", 1)], "marker_name string, marker_idx int")
    tables = workloads.report_tables(spark, files, markers, points=8)
    assert {(r["sample_id"], r["seg"], r["marker"]) for r in tables["marker_summary"].collect()} == {(s, g, m) for s in "ab" for g in "xy" for m in ("DAPI", "CD8")}
    workloads.publish({"area": tables["area_summary"]}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/area")).count() == 4
    odd = tmp_path / "odd.csv"
    odd.write_text("CellID,DAPI,Area\n1,2,3\n")
    more = files.union(spark.createDataFrame([("c", "x", str(odd))], files.schema))
    with pytest.raises(ValueError, match="other markers"):
        workloads.report_tables(spark, more, markers)
