"""Image metadata: channel names, axes, pyramid levels and tile positions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.scalar import contains_ci, round_half_up

OME = "Image struct<Pixels: struct<_PhysicalSizeX: double, _PhysicalSizeY: double, _SizeX: int, _SizeY: int, Channel: array<struct<_ID: string, _Name: string>>>>"


def parse_ome_xml(df: DataFrame, xml: str = "xml") -> DataFrame:
    """``df`` with physical_size_x, physical_size_y (null unless both are there) and channel_names in document order.

    A channel without a name is '' and keeps its place; XML that can't be read gives nulls and no names.
    """
    pixels = F.from_xml(F.col(xml), OME)["Image"]["Pixels"]
    both = pixels["_PhysicalSizeX"].isNotNull() & pixels["_PhysicalSizeY"].isNotNull()
    names = F.transform(pixels["Channel"], lambda c: F.coalesce(c["_Name"], F.lit("")))
    return df.withColumns({
        "physical_size_x": F.when(both, pixels["_PhysicalSizeX"]),
        "physical_size_y": F.when(both, pixels["_PhysicalSizeY"]),
        "channel_names": F.coalesce(names, F.array().cast("array<string>")),
    })


def channels_of(df: DataFrame) -> DataFrame:
    """(sample_id, channel, name) from parsed metadata."""
    return df.select("sample_id", F.posexplode("channel_names").alias("channel", "name"))


def parse_vendor_xml(df: DataFrame, xml: str = "xml", resolution: str | None = None) -> DataFrame:
    """``df`` with channel_names of ``<channel name>`` in order, and um_per_px from a pixels-per-um column."""
    out = df.withColumn("channel_names", F.xpath(F.col(xml), F.lit("//channel/@name")))
    return out if resolution is None else out.withColumn("um_per_px", F.try_divide(F.lit(1.0), F.col(resolution)))


def first_match(channels: DataFrame, name: str = "DAPI") -> DataFrame:
    """(sample_id, channel): the first channel whose name contains ``name`` in upper case; samples without one: channel null."""
    return channels.groupBy("sample_id").agg(F.min(F.when(contains_ci(F.col("name"), F.lit(name)), F.col("channel"))).alias("channel"))


def extract_channel(tiles: DataFrame, channels: DataFrame, name: str = "DAPI") -> DataFrame:
    """The blocks (or pixels) of each sample's first channel that matches ``name``."""
    return tiles.join(first_match(channels, name), ["sample_id", "channel"], "left_semi")


def channel_violations(channels: DataFrame, counts: DataFrame, name: str = "DAPI") -> DataFrame:
    """Samples without such a channel, or whose channel lies beyond the image's (``counts``: sample_id, n_channels)."""
    found = counts.join(first_match(channels, name), "sample_id", "left")
    message = F.when(F.col("channel").isNull(), "no channel of that name").when(F.col("channel") >= F.col("n_channels"), "channel index beyond the image")
    return found.select("sample_id", message.alias("message")).where("message is not null")


#: Rows that a marker sheet may have.
MOST_MARKERS = 100_000


def match_channels(channels: DataFrame, markers: DataFrame) -> DataFrame:
    """(sample_id, marker_name, marker_idx, channel, n_matches, new_channel): each marker's first containing channel.

    Markers without a match have a null channel (left out of the numbering); n_matches over 1 is ambiguous, the first counts.
    Channel names are filed under their parts of up to three letters, and a marker looks up its own first three (or all): only
    those names are searched. A result has a row for each sample and marker, so the sheet, whose size is checked, is
    given to every sample.
    """
    sheet = markers.select("marker_name", "marker_idx")
    if sheet.limit(MOST_MARKERS + 1).count() > MOST_MARKERS:
        raise ValueError(f"a marker sheet has at most {MOST_MARKERS} rows")
    rows = sheet.agg(F.collect_list(F.struct("marker_name", "marker_idx")).alias("m"))
    asked = channels.select("sample_id").distinct().select("sample_id", F.inline(rows.scalar()))
    upper, many = F.upper("name"), F.length(F.upper("name"))
    starts = lambda n: F.when(many >= n, F.transform(F.sequence(F.lit(1), many - n + 1), lambda i: F.substring(upper, i, F.lit(n))))
    parts = F.array_distinct(F.flatten(F.array_compact(F.array(F.array(F.lit("")), *[starts(n) for n in (1, 2, 3)]))))
    filed = channels.where("name is not null").select("sample_id", "channel", "name", F.explode(parts).alias("_part"))
    sought = sheet.where("marker_name is not null").withColumn("_part", F.substring(F.upper("marker_name"), 1, 3))
    hit = filed.join(sought, "_part").where(contains_ci(F.col("name"), F.col("marker_name")))
    best = hit.groupBy("sample_id", "marker_name", "marker_idx").agg(F.min("channel").alias("channel"), F.count("*").alias("n_matches"))
    out = asked.join(best, ["sample_id", "marker_name", "marker_idx"], "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    nth = F.count("channel").over(Window.partitionBy("sample_id").orderBy("marker_idx")) - 1
    return out.withColumn("new_channel", F.when(F.col("channel").isNotNull(), nth))


def select_channels(tiles: DataFrame, channels: DataFrame, markers: DataFrame) -> DataFrame:
    """Blocks of the matched channels, renumbered in marker order; two markers may pick the same channel."""
    picked = match_channels(channels, markers).where("channel is not null").select("sample_id", "channel", F.col("new_channel").alias("_new"))
    return tiles.join(picked, ["sample_id", "channel"]).withColumn("channel", F.col("_new").cast("int")).drop("_new")


def attach_markers(df: DataFrame, markers: DataFrame) -> DataFrame:
    """Every row with every row of the marker sheet, which is small."""
    return df.crossJoin(F.broadcast(markers))


def tile_regions(tiles: DataFrame) -> DataFrame:
    """x and y of each tile's top left pixel from its resolution and position tags; tiles without usable tags are left out."""
    ok = tiles.where(F.col("width").isNotNull() & F.col("height").isNotNull())
    out = ok.withColumns({"x": round_half_up(F.col("x_res") * F.col("x_pos")), "y": round_half_up(F.col("y_res") * F.col("y_pos"))})
    return out.where("x is not null and y is not null")


def rational(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def detect_axes(axes: Column, shape: Column) -> Column:
    """Axes letters: the declared ones (others than TCZYX read as C) if they name Y and X, else by the number of dimensions."""
    declared = F.regexp_replace(F.upper(axes), "[^TCZYX]", "C")
    named = declared.contains("Y") & declared.contains("X")
    last = F.element_at(shape, -1)
    guess = (
        F.when(F.size(shape) == 3, F.when(last.isin(3, 4), "YXC").otherwise("ZYX"))
        .when(F.size(shape) == 4, "CZYX").when(F.size(shape) == 5, "TCZYX").otherwise("YX")
    )
    return F.when(F.coalesce(named, F.lit(False)), declared).otherwise(guess)


def size_along(axis: str, axes: Column, shape: Column) -> Column:
    """The extent of an axis, null where it is absent. A shape of more dimensions than letters is read from its end."""
    at = F.instr(axes, axis)
    return F.when(at > 0, F.try_element_at(shape, (F.size(shape) - F.length(axes) + at).cast("int")))


def analyze_levels(levels: DataFrame, target: float = 1.0) -> DataFrame:
    """``levels`` with axes, scale, eff, k, final and err; physical sizes are those of level 0. See ``level_violations``."""
    w = Window.partitionBy("sample_id").orderBy("level")
    axes = detect_axes(F.col("axes"), F.col("shape"))
    out = levels.withColumn("axes", axes).withColumn("_x", size_along("X", F.col("axes"), F.col("shape")))
    out = out.withColumn("scale", round_half_up(F.first("_x").over(w) / F.col("_x")))
    out = out.withColumn("eff", F.first("physical_size_x").over(w) * F.col("scale"))
    out = out.withColumn("k", round_half_up(F.try_divide(F.lit(target), F.col("eff"))))
    out = out.withColumn("final", F.col("eff") * F.col("k"))
    return out.withColumn("err", F.abs(F.col("final") - target)).drop("_x")


def select_level(analysed: DataFrame) -> DataFrame:
    """(sample_id, level, k, message): the level to read, by going through a sample's levels in order.

    Levels with k = 0 are passed over. The first level with k = 1 and an error of at most 0.15 is taken at once. Else a level is
    better if its error is smaller by over 0.1; or if errors are within 0.1 and it needs no scaling while the best does, or
    both are alike in that and it is the higher level. No usable level, or no physical size: a message, and no k.
    """
    start = F.struct(F.lit(0).alias("level"), F.lit(0.0).alias("k"), F.lit(float("inf")).alias("err"), F.lit(True).alias("scaled"), F.lit(False).alias("done"))

    def step(best: Column, x: Column) -> Column:
        scaled = x["k"] != 1
        near = F.abs(x["err"] - best["err"]) < 0.1
        better = (x["err"] < best["err"] - 0.1) | (near & ((~scaled & best["scaled"]) | ((scaled == best["scaled"]) & (x["level"] > best["level"]))))
        at_once = (x["err"] <= 0.15) & ~scaled
        taken = F.struct(x["level"].alias("level"), x["k"].alias("k"), x["err"].alias("err"), scaled.alias("scaled"), at_once.alias("done"))
        return F.when(best["done"] | x["k"].isNull() | (x["k"] == 0), best).when(at_once | better, taken).otherwise(best)

    each = analysed.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct(F.col("level").cast("int").alias("level"), F.col("k").cast("double").alias("k"), F.col("err").cast("double").alias("err")))).alias("ls"))
    best = each.withColumn("b", F.aggregate("ls", start, step))
    missing = F.exists("ls", lambda x: x["k"].isNull())
    message = F.when(missing, "no physical size").when(F.col("b.k") == 0, "no level can be scaled to the target")
    return best.select("sample_id", F.col("b.level").alias("level"), F.when(message.isNull(), F.col("b.k")).alias("k"), message.alias("message"))


def update_image_metadata(meta: DataFrame, k: str = "k") -> DataFrame:
    """Metadata after rescaling: sizes from ``shape`` and ``axes`` (absent axis 1), physical sizes times k in um, names.

    Channel names are kept if there are as many as channels, else made anew as ``Channel:i``.
    """
    n = F.coalesce(size_along("C", F.col("axes"), F.col("shape")), F.lit(1))
    sizes = {f"size_{a.lower()}": F.coalesce(size_along(a, F.col("axes"), F.col("shape")), F.lit(1)) for a in "XYCZT"}
    names = F.when(F.size("channel_names") == n, F.col("channel_names")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("Channel:"), i.cast("string"))))
    physical = {f"physical_size_{a}": F.col(f"physical_size_{a}") * F.col(k) for a in "xy"}
    return meta.withColumns({**sizes, **physical, "channel_names": names, "dimension_order": F.reverse(F.col("axes")), "physical_size_unit": F.lit("µm")})


def to_ome_xml(meta: DataFrame) -> Column:
    """The updated metadata as an XML text."""
    channel = F.transform("channel_names", lambda n, i: F.struct(F.concat(F.lit("Channel:"), i.cast("string")).alias("_ID"), n.alias("_Name")))
    pixels = F.struct(
        *[F.col(f"size_{a.lower()}").alias(f"_Size{a}") for a in "XYCZT"], F.col("physical_size_x").alias("_PhysicalSizeX"), F.col("physical_size_y").alias("_PhysicalSizeY"),
        F.col("physical_size_unit").alias("_PhysicalSizeXUnit"), F.col("physical_size_unit").alias("_PhysicalSizeYUnit"), F.col("dimension_order").alias("_DimensionOrder"), channel.alias("Channel"),
    )
    return F.to_xml(F.struct(F.struct(pixels.alias("Pixels")).alias("Image")), {"rowTag": "OME"})


def scale_metadata_json(scaled: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(sample_id, json): a record of how each image was scaled."""
    return scaled.select("sample_id", F.to_json(F.struct(*fields)).alias("json"))


def infer_plane_shape(shape: Column, rows: Column, cols: Column, samples: Column) -> Column:
    """(rows, cols, samples) is turned to (samples, rows, cols); two dimensions are (rows, cols); all else takes that form."""
    return F.when(F.size(shape) == 2, F.array(rows, cols)).otherwise(F.array(samples, rows, cols))


def plane_axes_ok(axes: Column) -> Column:
    return axes.isin("IYX", "CYX")
