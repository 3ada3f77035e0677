import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_pixels import array, image, mask_frame
from tissuemill.operators import blocks, halo, pixels

RNG = np.random.default_rng(11)


def back(tiles, value="value"):
    return array(pixels.to_pixels(tiles, value), value)


@pytest.mark.parametrize(("side", "size", "reach"), [(128, 32, 1), (100, 32, 5), (64, 16, 16), (50, 8, 19)])
def test_strips_are_all_that_is_shuffled(spark, side, size, reach):
    """Values sent: the blocks, and strips of at most 4 * halo / size and the corners; a filter gets the same surroundings."""
    a = RNG.random((side, side))
    tiles = pixels.to_tiles(image(spark, a), size).withColumn("values", F.col("values").cast("array<float>"))
    sent = halo.halo_parts(tiles, reach, size)
    assert dict(sent.dtypes)["values"] == "array<float>"  # in the image's own type
    share = sent.agg(F.sum(F.size("values"))).first()[0] / a.size
    if reach <= size:
        assert share <= 1 + 4 * reach / size + 4 * (reach / size) ** 2
    assert sent.where("size(values) <> h * w or gy < 0 or gx < 0").count() == 0
    wide = np.pad(a, reach, mode="edge")
    want = np.max([wide[i : i + side, j : j + side] for i in range(2 * reach + 1) for j in range(2 * reach + 1)], axis=0)
    most = lambda v: np.max([np.pad(v, reach, mode="edge")[i : i + v.shape[0], j : j + v.shape[1]] for i in range(2 * reach + 1) for j in range(2 * reach + 1)], axis=0)
    assert np.allclose(back(halo.map_halo_tiles(tiles, most, reach, size)), want)


def test_boundaries_send_a_rim(spark):
    labels = RNG.integers(0, 4, (128, 128)).astype(float)
    mask = pixels.to_tiles(mask_frame(spark, labels).withColumn("channel", F.lit(0)), 32, "cell_id")
    n = halo.halo_parts(mask, 1, 32).agg(F.sum(F.size("values"))).first()[0]
    assert n <= labels.size * (1 + 4 / 32 + 4 / 32**2)
    assert (back(halo.boundary_tiles(mask, 32)) == array(pixels.outer_boundaries(mask_frame(spark, labels)))).all()


@pytest.mark.parametrize("size", [4, 7, 64])
def test_cut_and_paste(spark, size):
    """Blocks of odd places are cut along the grid and give the image again."""
    a = RNG.random((23, 31))
    tiles = pixels.to_tiles(image(spark, a), 10)
    pieces = blocks.cut(tiles, size)
    assert pieces.where(f"y0 div {size} <> ty or (y0 + h - 1) div {size} <> ty or x0 div {size} <> tx or size(values) <> h * w").count() == 0
    assert np.allclose(back(blocks.paste(pieces.withColumns({"path": F.lit("p"), "height": F.lit(23), "width": F.lit(31)}), size)), a)


def test_stitch_on_blocks(spark):
    fields = {"a": RNG.random((20, 30)), "b": RNG.random((25, 18)), "c": RNG.random((9, 9))}
    at = {"a": (100, 57), "b": (112, 80), "c": (160, 140)}  # a and b overlap; c leaves gaps
    px = None
    for name, v in fields.items():
        one = image(spark, v).withColumn("path", F.lit(name))
        px = one if px is None else px.union(one)
    regions = spark.createDataFrame([("s", n, x, y) for n, (y, x) in at.items()], "sample_id string, path string, x int, y int")
    want = array(pixels.stitch(px, regions))
    for inner, size in ((10, 16), (64, 8), (7, 100)):
        tiles = pixels.to_tiles(px, inner, by=("sample_id", "path", "channel"))
        got = blocks.stitch_tiles(tiles, regions, size)
        assert np.allclose(back(got), want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan  # no pixel rows
    assert got.count() == 1 and got.first().h == want.shape[0]


@pytest.mark.parametrize(("k", "integer"), [(1, False), (2, False), (3, True), (5, False)])
def test_rescale_on_blocks(spark, k, integer):
    a = np.rint(RNG.random((37, 29)) * 9) if integer else RNG.random((37, 29))
    px = image(spark, a).union(image(spark, a[:20, :7], "t"))
    factors = spark.createDataFrame([("s", k), ("t", 2)], "sample_id string, k int")
    want = pixels.downscale_by(px, factors, integer)
    for inner, size in ((8, 8), (10, 6)):
        got = blocks.rescale_tiles(pixels.to_tiles(px, inner), factors, size, integer)
        for s in "st":
            assert np.allclose(back(got.where(f"sample_id = '{s}'")), array(want.where(f"sample_id = '{s}'")))
        assert got.where(f"h > {size} or w > {size} or y0 <> ty * {size}").count() == 0


def test_pyramid_on_blocks_reads_the_image_once(spark):
    a = np.rint(RNG.random((41, 50)) * 20)
    tiles = pixels.to_tiles(image(spark, a), 8)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    n = tiles.count()
    got = blocks.pyramid_tiles(tiles.mapInArrow(counted, tiles.schema), (2, 4, 8), 8, integer=True)
    levels = {i: back(got.where(f"level = {i}")) for i in range(3)}
    want = pixels.build_pyramid(image(spark, a), (2, 4, 8), integer=True)
    for i, v in levels.items():
        assert (v == array(want.where(f"level = {i}"))).all()
    assert reads.value <= 3 * n  # the samples' names, their extent and the first level: none for the others


def test_background_and_thresholds_on_blocks(spark):
    a, b = RNG.random((21, 17)), RNG.random((21, 17))
    tiles, other = pixels.to_tiles(image(spark, a), 8), pixels.to_tiles(image(spark, b), 8)
    assert np.allclose(back(blocks.bg_mean_tiles(tiles)), np.clip(a - a.mean(), 0, None))
    assert np.allclose(back(blocks.bg_af_tiles(tiles, other)), np.clip(a - b, 0, None))
    whole = pixels.to_tiles(image(spark, np.rint(a * 30)), 8)
    for t, integer in ((tiles, False), (whole, True)):
        px = pixels.to_pixels(t)
        hist = blocks.histogram_tiles(t, integer=integer)
        assert sorted(hist.collect()) == sorted(pixels.intensity_histogram(px, integer=integer).collect())
        cuts = pixels.otsu_of(hist, 0.1)
        assert cuts.collect() == pixels.otsu(px, 0.1, integer=integer).collect()
        assert (back(blocks.binarise_tiles(t, cuts)) == array(pixels.binarise(px, cuts))).all()
    assert blocks.check_not_blank_tiles(tiles).count() == 0 and blocks.check_not_blank_tiles(pixels.to_tiles(image(spark, a * 0), 8)).count() == 1


def test_masks_and_overlays_on_blocks(spark):
    a, labels = RNG.random((21, 17)), np.zeros((21, 17))
    labels[2:9, 5:12], labels[12:18, 9:15] = 3, 8
    tiles = pixels.to_tiles(image(spark, a), 8)
    mask = blocks.paint(tiles, blocks.pieces_of(mask_frame(spark, labels), 8), 8)
    assert (back(mask) == labels).all() and mask.count() == tiles.count()
    lines = halo.boundary_tiles(mask, 8)
    bw = blocks.bw_overlay_tiles(tiles, lines)
    assert np.allclose(back(bw.where("channel = 0")), a) and (back(bw.where("channel = 1")) == back(lines)).all()
    rgb = blocks.rgb_overlay_tiles(tiles, lines)
    want = pixels.rgb_overlay(image(spark, a), pixels.to_pixels(lines))
    for c in "rgb":
        assert (back(rgb.withColumnRenamed(c, "values").drop(*set("rgb") - {c})) == array(want, c)).all()
