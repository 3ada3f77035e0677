"""Imaging tables seen in the general-purpose tables that the registered queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MARKERS = ["DAPI", "HLA.ABC", "CD3", "CD11c"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide cell table; ids repeat. row_key orders the rows."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("sample_id"), (c("l_orderkey") * 8 + c("l_linenumber")).alias("cell_id"),
        c("l_quantity").alias("DAPI"), c("l_extendedprice").alias("HLA.ABC"), (c("l_discount") * 100 + 0.0).alias("CD3"), (c("l_tax") * 100 + 0.0).alias("CD11c"),
        c("l_partkey").cast("double").alias("X_centroid"), c("l_suppkey").cast("double").alias("Y_centroid"), c("l_quantity").alias("Area"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("row_key"),
    )


CELLS = """cells AS (SELECT l_returnflag || l_linestatus AS sample_id, l_orderkey * 8 + l_linenumber AS cell_id,
  l_quantity AS "DAPI", l_extendedprice AS "HLA.ABC", l_discount * 100 + 0.0 AS "CD3", l_tax * 100 + 0.0 AS "CD11c",
  l_partkey::DOUBLE AS "X_centroid", l_suppkey::DOUBLE AS "Y_centroid", l_quantity AS "Area",
  l_shipdate, l_partkey, l_suppkey FROM lineitem)"""
LONG = "long AS (" + " UNION ALL ".join(f"SELECT sample_id, cell_id, '{m}' AS marker, \"{m}\" AS value FROM cells" for m in MARKERS) + ")"
CLR = "clr AS (SELECT *, ln(1 + value) - avg(ln(1 + value)) OVER (PARTITION BY sample_id, cell_id) AS clr FROM long)"


def pixels(spark: SparkSession, sf_dir: str, mirrored: bool = False) -> DataFrame:
    """Images of 64 pixels' width and up to 250 rows; mirrored: a second image of each sample."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("x", "value"))
    x = 63 - F.col("x") if mirrored else F.col("x")
    return e.select(
        F.concat(F.lit("img"), F.floor(F.col("vec_id") / 250).cast("string")).alias("sample_id"), F.lit(0).alias("channel"),
        (F.col("vec_id") % 250).cast("int").alias("y"), x.cast("int").alias("x"), F.col("value").cast("double").alias("value"),
    )


PIXELS = """pixels AS MATERIALIZED (SELECT 'img' || (vec_id // 250)::VARCHAR AS sample_id, 0 AS channel, (vec_id % 250)::INT AS y, (i - 1)::INT AS x, embedding[i]::DOUBLE AS value
  FROM embeddings, range(1, 65) AS r(i)), mirrored AS MATERIALIZED (SELECT sample_id, channel, y, (63 - x)::INT AS x, value FROM pixels)"""

#: Pixels with the mirrored image's value beside their own, without a join: for twins that need no more.
PLAIN = """plain AS (SELECT 'img' || (vec_id // 250)::VARCHAR AS sample_id, (vec_id % 250)::INT AS y, unnest(embedding)::DOUBLE AS value, unnest(list_reverse(embedding))::DOUBLE AS other,
  (generate_subscripts(embedding, 1) - 1)::INT AS x FROM embeddings)"""


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells are the positive pixels of 5 x 5 squares."""
    label = F.floor(F.col("y") / 5) * 13 + F.floor(F.col("x") / 5) + 1
    return pixels(spark, sf_dir).select("sample_id", F.lit(0).alias("plane"), "y", "x", F.when(F.col("value") > 0, label).otherwise(0).cast("int").alias("cell_id"))


MASK = PIXELS + ", mask AS MATERIALIZED (SELECT sample_id, 0 AS plane, y, x, CASE WHEN value > 0 THEN y // 5 * 13 + x // 5 + 1 ELSE 0 END AS cell_id FROM pixels)"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("s"), (F.col("vec_id") % 2).cast("string")).alias("sample_id"), F.col("vec_id").alias("cell_id"), v.alias("v"))


FEATURES = "features AS (SELECT 's' || (vec_id % 2)::VARCHAR AS sample_id, vec_id AS cell_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("s"), (F.col("vec_id") % 2).cast("string")).alias("sample_id"), F.col("vec_id").alias("cell_id"), F.lit(1.0).alias("resolution"), F.col("label").alias("cluster"))


LABELS = "labels AS (SELECT 's' || (vec_id % 2)::VARCHAR AS sample_id, vec_id AS cell_id, 1.0::DOUBLE AS resolution, label AS cluster FROM embeddings)"


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with files; some rows break the rules."""
    kind = F.col("event_type")
    form = F.when(kind == "view", "tiles").when(kind == "signup", "stitched").when(kind == "click", "fused").when(kind == "error", "bad")
    sample = F.concat(F.when(F.col("user_id") % 7 == 0, "s ").otherwise("s"), F.col("user_id").cast("string"))
    end = F.element_at(F.array(F.lit(".tif"), F.lit(".tiff"), F.lit(".png")), (F.col("event_id") % 3 + 1).cast("int"))
    path = F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("/data/"), (F.col("event_id") % 60).cast("string"), F.lit("/f "), F.col("event_id").cast("string"), end))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), sample.alias("sample_id"), path.alias("path"), form.alias("format"))


MANIFEST = """manifest AS (SELECT event_id AS row_id, (CASE WHEN user_id % 7 = 0 THEN 's ' ELSE 's' END) || user_id AS sample_id,
  CASE WHEN event_id % 11 <> 0 THEN '/data/' || (event_id % 60) || '/f ' || event_id || CASE event_id % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.tiff' ELSE '.png' END END AS path,
  CASE event_type WHEN 'view' THEN 'tiles' WHEN 'signup' THEN 'stitched' WHEN 'click' THEN 'fused' WHEN 'error' THEN 'bad' END AS format FROM events)"""


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image for every five parts, a channel for each of them."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(F.floor(key / 5).cast("string").alias("sample_id"), (key % 5).cast("int").alias("channel"), F.concat_ws(" ", "p_type", "p_name").alias("name"))


CHANNELS = "channels AS (SELECT (p_partkey // 5)::VARCHAR AS sample_id, (p_partkey % 5)::INT AS channel, p_type || ' ' || p_name AS name FROM part)"


def type_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker sheet: the kinds of parts, in order of their names."""
    kinds = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("marker_name")).agg(F.count("*").alias("n"))
    return kinds.select("marker_name", (F.row_number().over(Window.orderBy("marker_name")) - 1).alias("marker_idx"))


TYPE_SHEET = "m AS (SELECT p_type AS marker_name, (row_number() OVER (ORDER BY p_type) - 1)::INT AS marker_idx FROM (SELECT DISTINCT p_type FROM part))"


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pyramids of four levels."""
    p, level = table(spark, sf_dir, "part"), F.col("p_partkey") % 4
    side = F.floor(F.lit(4096) / F.pow(F.lit(2), level)).cast("int")
    axes = F.element_at(F.array(F.lit("CYX"), F.lit("iyx"), F.lit("Q"), F.lit(None).cast("string")), (F.floor(F.col("p_partkey") / 4) % 4 + 1).cast("int"))
    physical = F.when(F.floor(F.col("p_partkey") / 4) % 9 != 0, F.round(0.1 + (F.floor(F.col("p_partkey") / 4) % 50) / 20.0, 3))
    return p.select(F.floor(F.col("p_partkey") / 4).cast("string").alias("sample_id"), level.cast("int").alias("level"), axes.alias("axes"), F.array(F.lit(5), side, side).alias("shape"), physical.alias("physical_size_x"))


LEVELS = """levels AS (SELECT (p_partkey // 4)::VARCHAR AS sample_id, (p_partkey % 4)::INT AS level,
  CASE p_partkey // 4 % 4 WHEN 0 THEN 'CYX' WHEN 1 THEN 'iyx' WHEN 2 THEN 'Q' END AS axes,
  [5, (4096 // (1 << (p_partkey % 4)::INT))::INT, (4096 // (1 << (p_partkey % 4)::INT))::INT] AS shape,
  CASE WHEN p_partkey // 4 % 9 <> 0 THEN round(0.1 + (p_partkey // 4 % 50) / 20.0, 3) END AS physical_size_x FROM part)"""
