import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissuemill.operators import report
from tissuemill.sources import cells as cell_source
from tissuemill.sources import manifest


def long_frame(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, cell_id string, marker string, value double")


def test_extreme_cells_pool_repeated_ids(spark):
    long = long_frame(spark, [("s", "1", "a", 1e30), ("s", "2", "a", 1.1e30), ("s", "3", "a", 6e29), ("s", "3", "a", 6e29)])
    flagged = report.flag_extreme_cells(long)
    assert sorted(r["cell_id"] for r in flagged.collect()) == ["2", "3"]
    kept, dropped = report.drop_cells(long, flagged), report.keep_cells(long, flagged)
    assert kept.count() + dropped.count() == long.count() and [r["cell_id"] for r in kept.collect()] == ["1"]


def test_make_unique_skips_taken_suffixes(spark):
    df = spark.createDataFrame([("s", c, i) for i, c in enumerate(["1", "1", "1.1", "x", "1", "x", "x.1"])] + [("t", "1", 0)], "sample_id string, cell_id string, row_id int")
    got = {(r["sample_id"], r["row_id"]): r["cell_id"] for r in report.make_unique(df, "row_id").collect()}
    assert [got[("s", i)] for i in range(7)] == ["1", "1.2", "1.1", "x", "1.3", "x.2", "x.1"] and got[("t", 0)] == "1"


def test_clr_sums_to_zero_and_wide_agrees(spark):
    rng = random.Random(1)
    cells = spark.createDataFrame([("s", i, *[rng.uniform(0, 50) for _ in range(3)]) for i in range(20)], "sample_id string, cell_id int, a double, b double, `c.d` double")
    markers = ["a", "b", "c.d"]
    long = report.clr(report.to_long(cells, markers))
    assert all(abs(r["t"]) < 1e-9 for r in long.groupBy("cell_id").agg(F.sum("clr").alias("t")).collect())
    wide = report.to_long(report.clr_wide(cells, markers), markers)
    a = {(r["cell_id"], r["marker"]): r["clr"] for r in long.collect()}
    assert all(abs(a[(r["cell_id"], r["marker"])] - r["value"]) < 1e-9 for r in wide.collect())


def test_density_close_to_exact_and_integrates(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([("s", rng.gauss(0, 1)) for _ in range(300)] + [("t", 5.0)] * 3, "sample_id string, value double")
    fast = {(r["sample_id"], r["k"]): r for r in report.density(df, ["sample_id"], points=128).collect()}
    exact = {(r["sample_id"], r["k"]): r for r in report.density_exact(df, ["sample_id"], points=128).collect()}
    assert len(fast) == 256 and all(abs(fast[k]["density"] - exact[k]["density"]) < 2e-3 for k in exact)
    xs = [fast[("s", k)]["x"] for k in range(128)]
    assert 0.9 < sum(fast[("s", k)]["density"] for k in range(128)) * (xs[1] - xs[0]) <= 1.01


@pytest.mark.parametrize("n", [5, 40])
def test_qq_points_and_line(spark, n):
    rng = random.Random(n)
    values = [round(rng.gauss(3, 2), 1) for _ in range(n)]
    long = long_frame(spark, [("s", str(i), "m", v) for i, v in enumerate(values)])
    got = sorted((r["i"], r["theoretical"], r["sample"]) for r in report.qq_points(long).collect())
    assert [g[2] for g in got] == sorted(values) and [g[0] for g in got] == list(range(1, n + 1))
    from statistics import NormalDist

    a = 3 / 8 if n <= 10 else 1 / 2
    assert all(abs(t - NormalDist().inv_cdf((i - a) / (n + 1 - 2 * a))) < 1e-6 for i, t, _ in got)
    line = report.qq_line(long).first()
    q25, q75 = np.quantile(values, [0.25, 0.75])
    assert abs(line["slope"] - (q75 - q25) / (2 * NormalDist().inv_cdf(0.75))) < 1e-6 and abs(line["intercept"] - (q25 + q75) / 2) < 1e-9


def test_sample_cells_size_and_repeatability(spark):
    long = long_frame(spark, [(s, str(i), m, 1.0) for s, k in (("s", 50), ("t", 7)) for i in range(k) for m in "ab"])
    for n in (7, 20, 50):
        got = report.sample_cells(long, n)
        assert {r["sample_id"]: r["c"] for r in got.groupBy("sample_id").agg(F.count_distinct("cell_id").alias("c")).collect()} == {"s": min(n, 50), "t": 7}
        assert sorted(got.collect()) == sorted(report.sample_cells(long.repartition(3), n).collect())


def test_box_and_correlation(spark):
    values = [float(v) for v in (1, 2, 3, 4, 5, 6, 7, 8, 9, 100)]
    long = long_frame(spark, [("s", str(i), "m", v) for i, v in enumerate(values)])
    box = report.box_stats(long).first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert (box["q1"], box["q3"], box["high_whisker"], box["low_whisker"], box["n_outliers"]) == (q1, q3, 9, 1, 1)
    assert [r["value"] for r in report.box_outliers(long).collect()] == [100.0]
    cells = spark.createDataFrame([("s", i, float(i), float(-2 * i)) for i in range(5)], "sample_id string, cell_id int, a double, b double")
    assert {(r["marker_a"], r["marker_b"]): r["r"] for r in report.correlation_matrix(cells, ["a", "b"]).collect()} == {("a", "a"): 1.0, ("b", "a"): -1.0, ("b", "b"): 1.0}


def test_marker_sets(spark):
    markers = spark.createDataFrame([("DAPI", 0), ("CD3", 1), ("XX", 2)], "marker_name string, marker_idx int")
    assert report.effective_markers(markers, ["CD3", "DAPI", "Area"]) == ["DAPI", "CD3"]
    assert [r["marker_name"] for r in report.missing_markers(markers, ["CD3", "DAPI"]).collect()] == ["XX"]
    assert report.marker_columns(["DAPI", "CD3"]) == ["CD3"] and report.meta_columns(["DAPI", "CD3", "Area"], ["CD3"]) == ["DAPI", "Area"]


def test_read_cells(spark, tmp_path):
    (tmp_path / "c.csv").write_text("CellID,HLA-ABC,2nd,if,Area\n1,1.5,2,3,4\n2,,2,3,4\n3,inf,2,3,4\n4,NaN,2,3,4\n5,2,3,4,5\n")
    got = cell_source.read_cells(spark, str(tmp_path / "c.csv"), "s").orderBy("row_id")
    assert got.columns == ["cell_id", "HLA.ABC", "X2nd", "if.", "Area", "row_id", "sample_id"] and [r["cell_id"] for r in got.collect()] == ["1", "5"]


def test_names(spark):
    assert cell_source.clean_names(spark, ["HLA-ABC", "2nd", ".5x", "if", " x ", ".a", "_b", "ä b"]) == ["HLA.ABC", "X2nd", "X.5x", "if.", "X.x.", ".a", "X_b", "ä.b"]


def test_manifest_reading_and_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text(f"sample,tiffs,format\na,{tmp_path}/t,\nb,{tmp_path}/t/x 1.tif,fused\nc,{tmp_path}/none,tiles\nd,{tmp_path}/t/z.png,tiles\n")
    (tmp_path / "t").mkdir()
    for n, start in (("x 1.tif", b"II*\0"), ("y.tiff", b"MM\0+"), ("z.png", b"\x89PNG"), ("W.TIF", b"II+")):
        (tmp_path / "t" / n).write_bytes(start)
    sheet = manifest.read_manifest(spark, str(tmp_path / "m.csv"))
    assert {r["sample_id"]: r["format"] for r in sheet.collect()} == {"a": "tiles", "b": "fused", "c": "tiles", "d": "tiles"}
    files = manifest.expand_files(sheet, manifest.list_files(spark, f"{tmp_path}/t"))
    found = {(r["sample_id"], (r["path"] or "").rpartition("/")[2], r["error"]) for r in files.collect()}
    assert {f[:2] for f in found if f[2] is None} == {("a", "x 1.tif"), ("a", "y.tiff"), ("b", "x 1.tif")}
    assert {(f[0], f[2]) for f in found if f[2]} == {("c", "no TIFF file found"), ("d", "not a TIFF file")}
    magic = manifest.check_tiff_magic(spark.read.format("binaryFile").load(f"{tmp_path}/t"))
    assert {r["path"].rpartition("/")[2]: r["is_tiff"] for r in magic.collect()} == {"x 1.tif": True, "y.tiff": True, "z.png": False, "W.TIF": False}
    built = manifest.build_manifest(manifest.list_files(spark, f"{tmp_path}/t"), "run")
    assert [r["tiffs"].rpartition("/")[2] for r in built.collect()] == ["x_1.tif"]
    assert manifest.validate_manifest(sheet).count() == 0
    branches = manifest.branch_by_format(sheet)
    assert sum(b.count() for b in branches.values()) == sheet.count()
    (tmp_path / "k.csv").write_text("marker_name,channel_name,cycle_number\nDAPI,c 1,1\nDAPI,c2,x\n,c3,2\n")
    bad = manifest.validate_markers(manifest.read_markers(spark, str(tmp_path / "k.csv")))
    assert sorted((r["row"], r["field"]) for r in bad.collect()) == [(0, "channel_name"), (0, "marker_name"), (1, "cycle_number"), (2, "marker_name")]


def test_write_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("s", "a", 1), ("s", "b", 2), ("t", "a", 3)], "sample_id string, seg string, v int")
    cell_source.write_partitioned(df, str(tmp_path / "o"), files=2)
    assert (tmp_path / "o" / "sample_id=s" / "seg=b").is_dir() and spark.read.parquet(str(tmp_path / "o")).count() == 3
    assert cell_source.read_tiles(spark, str(tmp_path / "o"), samples=["s"]).count() == 2


def test_summaries_match_numpy(spark):
    rng = random.Random(4)
    rows = [("s", str(i), "m", rng.expovariate(1)) for i in range(31)]
    got = report.marker_summary(long_frame(spark, rows)).first()
    v = np.array([r[3] for r in rows])
    assert all(math.isclose(got[n], w) for n, w in (("mean", v.mean()), ("median", np.median(v)), ("sd", v.std(ddof=1)), ("min", v.min()), ("max", v.max())))


def test_correlation_of_gaps_constants_and_many_markers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (50, 60))
    x[:, 3] = 7.25  # constant
    x[:, 5] = 2e6 - x[:, 4]
    gap = rng.random(x.shape) < 0.2
    names = [f"m{i}" for i in range(60)]
    rows = [("s", *(None if g else float(v) for v, g in zip(a, b, strict=True))) for a, b in zip(x, gap, strict=True)]
    df = spark.createDataFrame(rows, "sample_id string, " + ", ".join(f"{n} double" for n in names))
    got = {(r["marker_a"], r["marker_b"]): r["r"] for r in report.correlation_matrix(df.repartition(5), names).collect()}
    assert len(got) == 60 * 61 // 2
    for (a, b), r in got.items():
        i, j = int(a[1:]), int(b[1:])
        both = ~gap[:, i] & ~gap[:, j]
        if 3 in (i, j):
            assert r is None
        else:
            assert i >= j and abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) <= 0.00501
    assert got["m5", "m4"] == -1


def test_qq_points_over_many_ranges_and_a_common_value(spark):
    rng = random.Random(3)
    values = {m: [round(rng.gauss(0, 1), 2) for _ in range(300)] + [0.5] * 200 for m in "ab"}
    long = long_frame(spark, [("s", str(i), m, v) for m, vs in values.items() for i, v in enumerate(vs)])
    got = report.qq_points(long, run=64).collect()
    for m, vs in values.items():
        own = sorted((r["i"], r["sample"]) for r in got if r["marker"] == m)
        assert own == list(zip(range(1, 501), sorted(vs), strict=True))
    plan = report.qq_points(long)._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line for line in plan.splitlines() if "Window [" in line)


def test_a_large_sheet_is_matched_without_a_nested_loop(spark):
    from tissuemill.operators import meta

    channels = spark.createDataFrame([("s", i, f"Ch{i:04d} x") for i in range(2000)] + [("t", 0, None), ("t", 1, "ab")], "sample_id string, channel int, name string")
    markers = spark.createDataFrame([(f"h{i:04d}", i) for i in range(1500)] + [("a", 1500), ("", 1501), (None, 1502), ("zz", 1503)], "marker_name string, marker_idx int")
    found = meta.match_channels(channels, markers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    rows = {(r["sample_id"], r["marker_idx"]): (r["channel"], r["n_matches"]) for r in found.collect()}
    assert len(rows) == 2 * 1504 and all(rows["s", i] == (i, 1) for i in range(1500))
    assert rows["t", 1500] == (1, 1) and rows["s", 1501] == (0, 2000) and rows["t", 1501] == (1, 1) and rows["s", 1502] == (None, 0) and rows["t", 1503] == (None, 0)
