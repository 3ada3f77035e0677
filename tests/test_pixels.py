import random

import numpy as np
from pyspark.sql import functions as F

from tissuemill.operators import cluster, halo, meta, pixels, quantify


def image(spark, a, sample="s", channel=0):
    return spark.createDataFrame([(sample, channel, y, x, float(v)) for (y, x), v in np.ndenumerate(np.asarray(a, float))], "sample_id string, channel int, y int, x int, value double")


def array(df, value="value"):
    rows = df.collect()
    out = np.zeros((max(r["y"] for r in rows) + 1, max(r["x"] for r in rows) + 1))
    for r in rows:
        out[r["y"], r["x"]] = r[value]
    return out


def mask_frame(spark, a):
    return image(spark, a).select("sample_id", F.lit(0).alias("plane"), "y", "x", F.col("value").cast("int").alias("cell_id"))


RNG = np.random.default_rng(0)


def test_blocks_and_back(spark):
    a = RNG.random((13, 9))
    assert np.allclose(array(pixels.to_pixels(pixels.to_tiles(image(spark, a), 4))), a)
    gaps = image(spark, a).where("(y + x) % 3 <> 0")
    assert np.allclose(array(pixels.to_pixels(pixels.to_tiles(gaps, 4))), np.where(np.add.outer(np.arange(13), np.arange(9)) % 3, a, 0))


def test_downscale(spark):
    a = np.arange(25.0).reshape(5, 5)
    want = a[:4, :4].reshape(2, 2, 2, 2).mean(axis=(1, 3))
    assert np.allclose(array(pixels.downscale(image(spark, a), 2)), want)
    assert np.allclose(array(pixels.to_pixels(pixels.downscale_tiles(pixels.to_tiles(image(spark, a), 4), 2))), want)
    halves = image(spark, [[2, 3, 3, 4]] * 2)
    assert array(pixels.downscale(halves, 2, integer=True)).tolist() == [[2.0, 4.0]]  # 2.5 and 3.5, half to even
    big = RNG.random((12, 8))
    assert np.isclose(array(pixels.downscale(image(spark, big), 4)).mean(), big.mean())


def test_stitch_first_path_wins_and_gaps(spark):
    tiles = image(spark, [[1, 1], [1, 1]]).withColumn("path", F.lit("a")).union(image(spark, [[2, 2], [2, 2]]).withColumn("path", F.lit("b")))
    regions = spark.createDataFrame([("s", "a", 10, 5), ("s", "b", 11, 6)], "sample_id string, path string, x int, y int")
    assert array(pixels.stitch(tiles, regions)).tolist() == [[1, 1, 0], [1, 1, 2], [0, 2, 2]]
    tags = spark.createDataFrame([("a", 2.0, 2.0, 5.25, 1.0, 4, 4), ("b", None, 2.0, 1.0, 1.0, 4, 4)], "path string, x_res double, y_res double, x_pos double, y_pos double, width int, height int")
    assert [(r["path"], r["x"], r["y"]) for r in meta.tile_regions(tags).collect()] == [("a", 11, 2)]


def test_backgrounds_do_not_hang_on_tiles(spark):
    a = RNG.random((21, 17))
    for size in (5, 8, 32):
        tiles = pixels.to_tiles(image(spark, a), size)
        assert np.allclose(array(pixels.to_pixels(halo.bg_gaussian(tiles, 1.5, size))), np.clip(a - halo.gaussian(a, 1.5), 0, None))
        assert np.allclose(array(pixels.to_pixels(halo.bg_rollingball(tiles, 3, size))), np.clip(a - halo.ball_background(a, 3), 0, None))
    assert np.allclose(array(pixels.bg_mean(image(spark, a))), np.clip(a - a.mean(), 0, None))
    b = RNG.random((21, 17))
    assert np.allclose(array(pixels.bg_af(image(spark, a), image(spark, b))), np.clip(a - b, 0, None))


def test_checks(spark):
    a = image(spark, [[0.0, 1], [1, 0]])
    assert pixels.check_shapes(a, a).count() == 0 and pixels.check_shapes(a, a.where("x = 0")).count() == 1
    assert pixels.check_not_blank(a).count() == 0 and pixels.check_not_blank(a.withColumn("value", F.lit(float("nan")))).count() == 1
    dirty = image(spark, [[np.nan, np.inf, -np.inf, 2]])
    assert array(pixels.clean_nonfinite(dirty)).tolist() == [[0, 0, 0, 2]] and pixels.count_nonfinite(dirty).first()["n_nonfinite"] == 3
    assert pixels.check_one_plane(pixels.stack_channels(a, a)).count() == 1


def test_boundaries(spark):
    one = np.zeros((5, 5))
    one[2, 2] = 1
    ring = array(pixels.outer_boundaries(mask_frame(spark, one)))
    assert (ring > 0).sum() == 4 and ring[2, 2] == 0
    two = np.zeros((4, 6))
    two[1:3, 1:3], two[1:3, 3:5] = 1, 2
    line = array(pixels.outer_boundaries(mask_frame(spark, two)))
    assert (line[1:3, 2:4] == 255).all() and line[1, 1] == 0
    rgb = pixels.rgb_overlay(image(spark, RNG.random((4, 6))), pixels.outer_boundaries(mask_frame(spark, two)))
    assert {r["r"] for r in rgb.collect()} == {0, 255} and rgb.agg(F.max("b")).first()[0] == 255
    bw = pixels.bw_overlay(image(spark, two), pixels.outer_boundaries(mask_frame(spark, two)))
    assert bw.where("channel = 1 and value = 255").count() == (line > 0).sum()


def test_axes_of_pixels(spark):
    a = image(spark, [[1, 2], [3, 4]])
    assert pixels.normalise_axes(a.drop("channel")).where("channel = 0").count() == 4 and pixels.normalise_axes(a) is a
    turned = pixels.permute_axes(a, (0, 2, 1))
    assert array(turned).tolist() == [[1, 3], [2, 4]] and sorted(pixels.permute_axes(a).collect()) == sorted(pixels.bg_none(a).select(*pixels.permute_axes(a).columns).collect())
    pyramid = pixels.build_pyramid(a, (1, 2))
    assert pyramid.where("level = 1").first()["value"] == 2.5


def test_otsu(spark):
    a = np.concatenate([RNG.normal(10, 1, 200), RNG.normal(50, 1, 200)]).reshape(20, 20)
    t = pixels.otsu(image(spark, a)).first()["threshold"]
    counts, edges = np.histogram(a, 256)
    centres = (edges[:-1] + edges[1:]) / 2
    w1, w2 = np.cumsum(counts), np.cumsum(counts[::-1])[::-1]
    m1, m2 = np.cumsum(counts * centres) / np.maximum(w1, 1), (np.cumsum((counts * centres)[::-1]) / np.maximum(w2[::-1], 1))[::-1]
    assert abs(t - centres[np.argmax(w1[:-1] * w2[1:] * (m1[:-1] - m2[1:]) ** 2)]) < 1e-6
    shifted = pixels.otsu(image(spark, a + 7)).first()["threshold"]
    assert abs(shifted - t - 7) < 0.3
    assert pixels.otsu(image(spark, [[4, 4]])).first()["threshold"] == 4
    b = pixels.binarise(image(spark, a), pixels.otsu(image(spark, a), 0.1))
    assert array(b).tolist() == np.where(a > t * 0.9, 255, 0).tolist()


def test_level_choice(spark):
    def chosen(physical, sides, target=1.0):
        df = spark.createDataFrame([("s", i, "YX", [n, n], physical) for i, n in enumerate(sides)], "sample_id string, level int, axes string, shape array<int>, physical_size_x double")
        return tuple(meta.select_level(meta.analyze_levels(df, target)).first())[1:]

    assert chosen(0.5, [400, 200, 100]) == (1, 1.0, None)
    assert chosen(0.65, [400, 200, 100]) == (1, 1.0, None)
    assert chosen(3.0, [400, 200])[2] == "no level can be scaled to the target" and chosen(None, [400])[2] == "no physical size"
    assert chosen(0.25, [400]) == (0, 4.0, None)


def test_axes(spark):
    df = spark.createDataFrame([(None, [4, 4]), (None, [4, 4, 3]), (None, [5, 4, 9]), (None, [5, 4, 4]), ("IYX", [2, 4, 4]), (None, [1, 2, 3, 4]), (None, [1, 1, 2, 3, 4]), ("Q", [4, 4])], "a string, s array<int>")
    assert [r[0] for r in df.select(meta.detect_axes(F.col("a"), F.col("s"))).collect()] == ["YX", "YXC", "ZYX", "YXC", "CYX", "CZYX", "TCZYX", "YX"]


def test_channels(spark):
    xml = '<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image><Pixels PhysicalSizeX="0.5" PhysicalSizeY="0.5"><Channel ID="0" Name="dapi 1"/><Channel ID="1"/><Channel ID="2" Name="CD31"/><Channel ID="3" Name="CD3"/></Pixels></Image></OME>'
    parsed = meta.parse_ome_xml(spark.createDataFrame([("s", xml), ("t", "no xml")], "sample_id string, xml string"))
    rows = {r["sample_id"]: r for r in parsed.collect()}
    assert rows["s"]["channel_names"] == ["dapi 1", "", "CD31", "CD3"] and rows["s"]["physical_size_x"] == 0.5 and rows["t"]["channel_names"] == []
    channels = meta.channels_of(parsed)
    assert meta.first_match(channels).first()["channel"] == 0
    markers = spark.createDataFrame([("CD3", 0), ("XX", 1), ("DAPI", 2)], "marker_name string, marker_idx int")
    got = [(r["marker_name"], r["channel"], r["n_matches"], r["new_channel"]) for r in meta.match_channels(channels, markers).orderBy("marker_idx").collect()]
    assert got == [("CD3", 2, 2, 0), ("XX", None, 0, None), ("DAPI", 0, 1, 1)]
    assert meta.channel_violations(channels, spark.createDataFrame([("s", 0), ("u", 1)], "sample_id string, n_channels int")).count() == 2


def hull_area(ys, xs):
    """The area of the convex hull of unit squares, by gift wrapping over all corners."""
    points = sorted({(y + a, x + b) for y, x in zip(ys.tolist(), xs.tolist(), strict=True) for a in (-0.5, 0.5) for b in (-0.5, 0.5)})
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    far = lambda a, b: (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2
    hull, now = [], points[0]
    while not hull or now != hull[0]:
        hull.append(now)
        nxt = points[0] if now != points[0] else points[1]
        for p in points:
            c = cross(now, nxt, p)
            if p != now and (c < 0 or c == 0 and far(now, p) > far(now, nxt)):
                nxt = p
        now = nxt
    return abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(hull, [*hull[1:], hull[0]], strict=True))) / 2


def test_quantification(spark):
    labels = np.zeros((12, 12))
    labels[1:4, 1:4], labels[5, 2:11], labels[7:10, 1], labels[9, 1:4] = 1, 2, 3, 3
    labels[11, 11] = 4
    values = RNG.random((12, 12))
    mask = mask_frame(spark, labels)
    shape = {r["cell_id"]: r for r in quantify.cell_morphology(mask).collect()}
    assert sum(r["Area"] for r in shape.values()) == (labels > 0).sum()
    assert shape[1]["Extent"] == 1 and shape[1]["Eccentricity"] == 0 and shape[2]["MinorAxisLength"] == 0 and abs(abs(shape[2]["Orientation"]) - np.pi / 2) < 1e-9
    assert shape[4]["MajorAxisLength"] == 0 and shape[4]["Eccentricity"] == 0
    solid = {r["cell_id"]: r["Solidity"] for r in quantify.cell_solidity(mask).collect()}
    assert abs(solid[1] - 1) < 1e-9 and abs(solid[2] - 1) < 1e-9 and abs(solid[4] - 1) < 1e-9 and abs(solid[3] - 5 / 7) < 1e-9
    shapes = RNG.integers(0, 2, (14, 40)) * np.kron(np.arange(1, 15).reshape(2, 7), np.ones((7, 6)))[:, :40]
    for r in quantify.cell_solidity(mask_frame(spark, shapes)).collect():
        ys, xs = np.nonzero(shapes == r["cell_id"])
        assert abs(r["Solidity"] - len(ys) / hull_area(ys, xs)) < 1e-9
    for size in (5, 12):
        tiles = pixels.to_tiles(image(spark, values), size)
        blocks = pixels.to_tiles(mask.withColumn("channel", F.lit(0)), size, "cell_id")
        got = {r["cell_id"]: r["value"] for r in quantify.cell_intensity(tiles, blocks).collect()}
        assert all(abs(got[c] - values[labels == c].mean()) < 1e-9 for c in (1, 2, 3, 4)) and len(got) == 4
    intensity = quantify.cell_intensity(tiles, blocks, "sum").withColumn("marker", F.lit("m.1"))
    assert quantify.cell_table(intensity, quantify.cell_morphology(mask), ["m.1"], quantify.cell_solidity(mask)).count() == 4


def test_segment_cuts_no_cell(spark):
    a = np.zeros((20, 20))
    a[2:5, 7:10], a[9:12, 9:12], a[15:18, 1:4] = 1, 1, 1

    def predict(area):
        labels, n = np.zeros(area.shape, int), 0
        for y, x in zip(*np.nonzero(area)):
            if labels[y, x] == 0:
                n += 1
                stack = [(y, x)]
                while stack:
                    p = stack.pop()
                    if 0 <= p[0] < area.shape[0] and 0 <= p[1] < area.shape[1] and area[p] and not labels[p]:
                        labels[p] = n
                        stack += [(p[0] + 1, p[1]), (p[0] - 1, p[1]), (p[0], p[1] + 1), (p[0], p[1] - 1)]
        return labels

    for size in (10, 8, 32):
        got = halo.segment(pixels.to_tiles(image(spark, a), size), predict, 4, size).groupBy("cell_id").count().collect()
        assert sorted(r["count"] for r in got) == [9, 9, 9]


def planted(spark, n=60, d=5):
    rng = np.random.default_rng(3)
    rows = [("s", i, (rng.normal(0, 0.3, d) + 6 * (i % 3 == np.arange(d))).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "sample_id string, cell_id long, v array<double>")


def test_clusters_of_planted_groups(spark):
    features = planted(spark)
    x = np.array([r["v"] for r in features.orderBy("cell_id").collect()])
    pc = np.array([r["pc"] for r in cluster.pca(features, 3).orderBy("cell_id").collect()])
    centred = x - x.mean(axis=0)
    _, s, _ = np.linalg.svd(centred)
    assert np.allclose(np.sort(np.linalg.norm(pc, axis=0))[::-1], s[:3])
    near = cluster.knn(cluster.pca(features, 3), 10, block=25)
    p = {r["cell_id"]: set() for r in features.collect()}
    for r in near.collect():
        p[r["cell_id"]].add(r["neighbour_id"])
    want = {i: set(np.argsort(((pc - pc[i]) ** 2).sum(1), kind="stable")[:10].tolist()) for i in range(60)}
    assert p == want
    edges = cluster.snn(near, 10)
    count = {(a, b): len(want[a] & want[b]) for a in want for b in want if a < b}
    assert {(r["src"], r["dst"]): round(r["weight"], 9) for r in edges.collect()} == {k: round(c / (20 - c), 9) for k, c in count.items() if c and c / (20 - c) >= 1 / 15}
    found = cluster.louvain(edges, 0.3)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["cluster"], set()).add(r["cell_id"] % 3)
    assert all(len(g) == 1 for g in groups.values()) and set(groups) == set(range(len(groups)))
    labels = features.select("sample_id", "cell_id", F.lit(1.0).alias("resolution"), (F.col("cell_id") % 3).cast("int").alias("cluster"))
    points = cluster.pca(features, 3)
    moved = cluster.transfer_labels(points.where("cell_id < 30"), labels, points, 5)
    assert all(r["cluster"] == r["cell_id"] % 3 for r in moved.collect()) and moved.count() == 60
    graph = cluster.fuzzy_graph(near, 10)
    assert graph.where("weight <= 0 or weight > 1 + 1e-9").count() == 0
    assert cluster.layout_2d(graph).count() == 60
    assert cluster.cluster_labels_2d(points.select("sample_id", "cell_id", F.get("pc", F.lit(0)).alias("x"), F.get("pc", F.lit(1)).alias("y")), labels).count() == 3


def test_sketch_and_scaling(spark):
    features = planted(spark)
    x = np.array([r["v"] for r in features.orderBy("cell_id").collect()])
    lev = {r["cell_id"]: r["leverage"] for r in cluster.leverage_scores(features).collect()}
    hat = np.einsum("ij,jk,ik->i", x, np.linalg.inv(x.T @ x), x)
    assert all(abs(lev[i] - hat[i]) < 1e-9 for i in lev)
    assert cluster.leverage_sample(features, 20).count() == 20 and cluster.leverage_sample(features, 60).count() == 60
    scaled = np.array([r["v"] for r in cluster.scale_features(features).orderBy("cell_id").collect()])
    assert np.allclose(scaled, np.minimum((x - x.mean(0)) / x.std(0, ddof=1), 10))
    one = cluster.clr_normalise(features.limit(1)).first()["v"]
    v = features.limit(1).first()["v"]
    m = np.exp(sum(np.log1p(t) for t in v if t > 0) / len(v))
    assert np.allclose(one, np.log1p(np.array(v) / m), equal_nan=True)


def test_tables_of_clusters(spark):
    rng = random.Random(1)
    long = spark.createDataFrame([("s", i, m, rng.random()) for i in range(20) for m in "abc"], "sample_id string, cell_id int, marker string, value double")
    labels = spark.createDataFrame([("s", i, 1.0, i % 2) for i in range(20)], "sample_id string, cell_id int, resolution double, cluster int")
    means = cluster.cluster_marker_means(long, labels).collect()
    assert len(means) == 6 and all(abs(sum(r["z"] for r in means if r["cluster"] == c)) < 1e-9 for c in (0, 1))
    dens = cluster.cluster_marker_density(long, labels, 16)
    assert dens.count() == 96 and dens.select("axis_low").distinct().count() == 1
    cells = spark.createDataFrame([("s", i, float(i), float(-i), 1.0) for i in range(20)], "sample_id string, cell_id int, X_centroid double, Y_centroid double, a double")
    at = cluster.spatial_map(cells, labels).where("cell_id = 3").first()
    assert (at["x"], at["y"]) == (-3, 3) and at["colour"].startswith("#")
    assert cluster.spatial_marker_map(cells, ["a"]).count() == 20
