"""The registered queries: each runs an operator over the driver's tables; SQL twins where SQL can express it.

Doubles are rounded on both sides, as engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuemill.functions import scalar, storage
from tissuemill.jobs import views, workloads
from tissuemill.jobs.views import CELLS, CHANNELS, CLR, FEATURES, LABELS, LEVELS, LONG, MANIFEST, MARKERS, MASK, PIXELS, PLAIN
from tissuemill.operators import blocks, cluster, halo, meta, pixels, quantify, report
from tissuemill.sources import cells as cell_files
from tissuemill.sources import manifest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, digits: int = 4) -> Callable:
    """Register a function under its name; doubles of its result are rounded to ``digits``."""

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df.select(*[(F.round(F.col(f"`{c}`"), digits) + 0.0).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def r(expression: str, digits: int = 4) -> str:
    return f"round({expression}, {digits}) + 0.0"


def _long(spark: SparkSession, d: str) -> DataFrame:
    return report.to_long(views.cells(spark, d), MARKERS)


# -- report -----------------------------------------------------------------------------------------------------------

SUMMARY = f"{r('avg(V)')} AS mean, {r('median(V)')} AS median, {r('stddev_samp(V)')} AS sd, {r('min(V)')} AS min, {r('max(V)')} AS max"


@query(f"WITH {CELLS}, {LONG} SELECT sample_id, cell_id, marker, {r('value')} AS value FROM long")
def r1_to_long(spark, d):
    return _long(spark, d)


@query(f"WITH {CELLS}, {LONG} SELECT sample_id, cell_id, {r('sum(value)')} AS total FROM long GROUP BY ALL HAVING sum(value) > 120000")
def r2_flag_extreme_cells(spark, d):
    return report.flag_extreme_cells(_long(spark, d), 120_000)


@query(f'WITH {CELLS} SELECT sample_id, round(avg("Area"), 2) AS mean, median("Area") AS median, round(stddev_samp("Area"), 2) AS sd, min("Area") AS min, max("Area") AS max FROM cells GROUP BY sample_id')
def r3_area_summary(spark, d):
    return report.area_summary(views.cells(spark, d))


@query(f"WITH {CELLS}, {LONG} SELECT sample_id, marker, {SUMMARY.replace('V', 'value')} FROM long GROUP BY sample_id, marker")
def r4_marker_summary(spark, d):
    """Extreme cells out first, as in the report's order of steps."""
    long = _long(spark, d)
    return report.marker_summary(report.drop_cells(long, report.flag_extreme_cells(long)))


@query(f"WITH {CELLS}, {LONG}, {CLR} SELECT sample_id, marker, {SUMMARY.replace('V', 'clr')} FROM clr GROUP BY sample_id, marker")
def r5_marker_summary_clr(spark, d):
    return report.marker_summary_clr(_long(spark, d))


@query(f"WITH {CELLS}, {LONG}, {CLR} SELECT sample_id, cell_id, marker, {r('value')} AS value, {r('clr')} AS clr FROM clr")
def w1_clr(spark, d):
    return report.clr(_long(spark, d))


@query(
    "WITH " + CELLS + ", " + ", ".join(["m AS (SELECT *, (" + " + ".join(f'ln(1 + "{m}")' for m in MARKERS) + ") / 4 AS mean FROM cells)"])
    + " SELECT sample_id, cell_id, " + ", ".join(f'{r(f"""ln(1 + "{m}") - mean""")} AS "{m}"' for m in MARKERS) + " FROM m"
)
def w1_clr_wide(spark, d):
    return report.clr_wide(views.cells(spark, d).select("sample_id", "cell_id", *[f"`{m}`" for m in MARKERS]), MARKERS)


DENSITY = f"""WITH {CELLS}, {LONG},
s AS (SELECT sample_id, marker, count(value) AS n, min(value) AS low, max(value) AS high, stddev_samp(value) AS sd, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM long GROUP BY ALL),
b AS (SELECT *, 0.9 * CASE WHEN least(sd, iqr / 1.34) > 0 THEN least(sd, iqr / 1.34) WHEN sd > 0 THEN sd WHEN abs(low) > 0 THEN abs(low) ELSE 1.0 END * pow(n, -0.2) AS bw, (high - low) / 511 AS step FROM s),
a AS (SELECT sample_id, marker, CASE WHEN step > 0 THEN (value - low) / step ELSE 0.0 END AS spot FROM long JOIN b USING (sample_id, marker)),
l AS (SELECT *, least(floor(spot), 510) AS lo FROM a),
w AS (SELECT sample_id, marker, bin, sum(w) AS w FROM (
  SELECT sample_id, marker, lo AS bin, 1 - (spot - lo) AS w FROM l UNION ALL SELECT sample_id, marker, lo + 1, spot - lo FROM l) GROUP BY ALL HAVING sum(w) > 0)
SELECT sample_id, marker, k::INT AS k, {r('any_value(low) + k * any_value(step)', 6)} AS x,
  {r('sum(w * exp(-0.5 * pow((k - bin) * step / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi()))', 9)} AS density
FROM w JOIN b USING (sample_id, marker), range(0, 512) AS g(k) GROUP BY sample_id, marker, k"""


@query(DENSITY, 9)
def r6_density(spark, d):
    out = report.density(_long(spark, d), ["sample_id", "marker"], points=512)
    return out.withColumn("x", F.round("x", 6))


BOX = f"""WITH {CELLS}, {LONG}, q AS (SELECT sample_id, marker, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
j AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM long JOIN q USING (sample_id, marker)) """


@query(BOX + f"SELECT sample_id, marker, {r('any_value(q1)')} AS q1, {r('any_value(median)')} AS median, {r('any_value(q3)')} AS q3, {r('min(value) FILTER (inside)')} AS low_whisker, {r('max(value) FILTER (inside)')} AS high_whisker, count(*) FILTER (NOT inside) AS n_outliers FROM j GROUP BY sample_id, marker")
def r7_box_stats(spark, d):
    return report.box_stats(_long(spark, d))


# The tables' values are spread evenly, without outliers; their fourth powers have some.
TAILED = BOX.replace(LONG, LONG.replace("long AS", "flat AS", 1) + ", long AS (SELECT * REPLACE ((value * value) * (value * value) AS value) FROM flat)")


@query(TAILED + f"SELECT sample_id, cell_id, marker, {r('value')} AS value FROM j WHERE NOT inside")
def r7_box_outliers(spark, d):
    v = F.col("value")
    return report.box_outliers(_long(spark, d).withColumn("value", (v * v) * (v * v)))


CORR = " UNION ALL ".join(f"SELECT sample_id, '{b}' AS marker_a, '{a}' AS marker_b, round(corr(\"{a}\", \"{b}\"), 2) + 0.0 AS r FROM cells GROUP BY sample_id" for i, a in enumerate(MARKERS) for b in MARKERS[i:])


@query(f"WITH {CELLS} {CORR}")
def r8_correlation_matrix(spark, d):
    return report.correlation_matrix(views.cells(spark, d), MARKERS)


@query(f"WITH {FEATURES}, l AS MATERIALIZED (SELECT sample_id, cell_id, i, v[i] AS x FROM features, range(1, 65) AS g(i)) SELECT a.sample_id, 'm' || (a.i - 1) AS marker_a, 'm' || (b.i - 1) AS marker_b, round(corr(a.x, b.x), 2) + 0.0 AS r FROM l a JOIN l b ON a.sample_id = b.sample_id AND a.cell_id = b.cell_id AND a.i >= b.i GROUP BY ALL")
def r8_correlation_64_markers(spark, d):
    """All 2080 pairs of 64 markers, from matrices that the tasks add up."""
    names = [f"m{i}" for i in range(64)]
    wide = views.features(spark, d).select("sample_id", *[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return report.correlation_matrix(wide, names)


@query(f"WITH {CELLS} SELECT sample_id, count(DISTINCT cell_id) AS n_cells FROM cells GROUP BY sample_id")
def r9_count_cells(spark, d):
    return report.count_cells(views.cells(spark, d))


@query(f"WITH {CELLS}, {LONG} SELECT sample_id, cell_id, {r('sum(value)')} AS total, count(*) FILTER (value > 0) AS n_positive FROM long GROUP BY ALL")
def r10_cell_totals(spark, d):
    return report.cell_totals(_long(spark, d))


@query(f"""WITH {CELLS}, n AS (SELECT *, row_number() OVER (PARTITION BY sample_id, cell_id ORDER BY l_shipdate, l_partkey, l_suppkey, "HLA.ABC") - 1 AS nth FROM cells)
SELECT sample_id, cell_id::VARCHAR || CASE WHEN nth > 0 THEN '.' || nth ELSE '' END AS cell_id, "X_centroid" FROM n""")
def w2_make_unique(spark, d):
    return report.make_unique(views.cells(spark, d), "row_key").select("sample_id", "cell_id", "X_centroid")


def _normal(p: str) -> str:
    """The same quantile function in SQL. The published coefficients, as in functions.scalar."""
    a = "-39.69683028665376,220.9460984245205,-275.9285104469687,138.357751867269,-30.66479806614716,2.506628277459239".split(",")
    b = "-54.47609879822406,161.5858368580409,-155.6989798598866,66.80131188771972,-13.28068155288572,1.0".split(",")
    c = "-0.007784894002430293,-0.3223964580411365,-2.400758277161838,-2.549732539343734,4.374664141464968,2.938163982698783".split(",")
    e = "0.007784695709041462,0.3224671290700398,2.445134137142996,3.754408661907416,1.0".split(",")

    def horner(ks: list[str], x: str) -> str:
        out = ks[0]
        for k in ks[1:]:
            out = f"(({out}) * {x} + {k}::DOUBLE)"
        return out

    tail = lambda q: f"({horner(c, q)} / {horner(e, q)})"
    low, high, mid = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))", f"({p} - 0.5)"
    sq = f"({mid} * {mid})"
    return f"CASE WHEN {p} < 0.02425 THEN {tail(low)} WHEN {p} > 1 - 0.02425 THEN -{tail(high)} ELSE {horner(a, sq)} * {mid} / {horner(b, sq)} END"


@query(f"""WITH {CELLS}, {LONG}, n AS (SELECT sample_id, marker, value, row_number() OVER (PARTITION BY sample_id, marker ORDER BY value) AS i, count(*) OVER (PARTITION BY sample_id, marker) AS n FROM long),
p AS (SELECT *, (i - CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END::DOUBLE) / (n + 1 - 2 * CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END::DOUBLE) AS p FROM n)
SELECT sample_id, marker, i, {r(_normal('p'))} AS theoretical, {r('value')} AS sample FROM p""")
def w3_qq_points(spark, d):
    return report.qq_points(_long(spark, d))


@query(f"WITH {CELLS}, {LONG}, q AS (SELECT sample_id, marker, quantile_cont(value, 0.25) AS lo, quantile_cont(value, 0.75) AS hi FROM long GROUP BY ALL) SELECT sample_id, marker, {r('(hi - lo) / (2 * 0.6744897501960817)')} AS slope, {r('lo + (hi - lo) / 2')} AS intercept FROM q")
def w4_qq_line(spark, d):
    return report.qq_line(_long(spark, d))


@query(f"""WITH {CELLS}, {LONG}, d AS (SELECT DISTINCT sample_id, cell_id FROM cells),
s AS (SELECT sample_id, cell_id FROM d QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY md5(sample_id || ':' || cell_id || ':0'), cell_id) <= 5000)
SELECT sample_id, cell_id, marker, {r('value')} AS value FROM long SEMI JOIN s USING (sample_id, cell_id)""")
def t1_sample_cells(spark, d):
    return report.sample_cells(_long(spark, d), 5000)


@query(f"WITH {CELLS}, {LONG}, f AS (SELECT sample_id, cell_id FROM long GROUP BY ALL HAVING sum(value) > 120000) SELECT sample_id, cell_id, {r(chr(34) + 'X_centroid' + chr(34))} AS \"X_centroid\" FROM cells ANTI JOIN f USING (sample_id, cell_id)")
def j5_drop_cells(spark, d):
    cells = views.cells(spark, d)
    return report.drop_cells(cells, report.flag_extreme_cells(_long(spark, d), 120_000)).select("sample_id", "cell_id", "X_centroid")


@query(f"WITH {CELLS}, {LONG}, f AS (SELECT sample_id, cell_id FROM long GROUP BY ALL HAVING sum(value) > 120000) SELECT sample_id, cell_id, {r(chr(34) + 'X_centroid' + chr(34))} AS \"X_centroid\" FROM cells SEMI JOIN f USING (sample_id, cell_id)")
def j5_keep_cells(spark, d):
    cells = views.cells(spark, d)
    return report.keep_cells(cells, report.flag_extreme_cells(_long(spark, d), 120_000)).select("sample_id", "cell_id", "X_centroid")


@query(f"WITH {CELLS} SELECT DISTINCT sample_id, cell_id FROM cells")
def u4_distinct_cells(spark, d):
    return report.distinct_cells(views.cells(spark, d))


# -- manifest ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {MANIFEST} SELECT row_id AS row, 'sample_id' AS field, 'sample is missing or has white space' AS message FROM manifest WHERE sample_id LIKE '% %'
UNION ALL SELECT row_id, 'path', 'path is missing' FROM manifest WHERE path IS NULL
UNION ALL SELECT row_id, 'format', 'format must be tiles, stitched or fused' FROM manifest WHERE format = 'bad'""")
def v1_validate_manifest(spark, d):
    return manifest.validate_manifest(views.manifest(spark, d), "row_id")


@query("""SELECT p_partkey::INT AS row, 'marker_name' AS field, 'marker name is missing or has white space' AS message FROM part WHERE p_name LIKE '% %'
UNION ALL SELECT p_partkey::INT, 'cycle_number', 'cycle must be a whole number' FROM part WHERE p_size % 5 = 0
UNION ALL SELECT min(p_partkey)::INT, 'marker_name', 'marker name occurs more than once' FROM part GROUP BY p_name HAVING count(*) > 1""")
def v2_validate_markers(spark, d):
    p = views.table(spark, d, "part")
    cycle = F.when(F.col("p_size") % 5 == 0, "x").otherwise(F.col("p_size").cast("string"))
    return manifest.validate_markers(p.select(F.col("p_name").alias("marker_name"), F.col("p_brand").alias("channel_name"), cycle.alias("cycle_number"), F.col("p_partkey").cast("int").alias("marker_idx")))


@query(f"WITH {MANIFEST} SELECT row_id, sample_id, path, format FROM manifest WHERE format IN ('tiles', 'stitched', 'fused')")
def u1_union_of_branches(spark, d):
    return manifest.union_images(*manifest.branch_by_format(views.manifest(spark, d)).values())


@query(f"WITH {MANIFEST} SELECT format AS branch, row_id, sample_id, path FROM manifest WHERE format IN ('tiles', 'stitched', 'fused')")
def v3_branch_by_format(spark, d):
    named = [rows.select(F.lit(form).alias("branch"), "row_id", "sample_id", "path") for form, rows in manifest.branch_by_format(views.manifest(spark, d)).items()]
    return reduce(DataFrame.unionByName, named)


@query(f"WITH {MANIFEST} SELECT sample_id, count(path) AS n_files, array_to_string(list_sort(list(path) FILTER (path IS NOT NULL)), ',') AS files FROM manifest WHERE format IN ('stitched', 'fused') GROUP BY sample_id HAVING count(path) <> 1")
def v4_check_single_file(spark, d):
    return manifest.check_single_file(views.manifest(spark, d)).withColumn("files", F.array_join("files", ","))


@query(f"""WITH {MANIFEST}, listing AS (SELECT DISTINCT path AS file FROM manifest WHERE path IS NOT NULL),
asked AS (SELECT 's' || row_id AS sample_id, 'tiles' AS format, CASE WHEN row_id % 2 = 0 THEN '/data/' || (row_id % 70) ELSE coalesce(path, '/none') END AS asked FROM manifest),
known AS (SELECT file AS asked, file, true AS single FROM listing UNION ALL SELECT regexp_replace(file, '/[^/]*$', ''), file, false FROM listing WHERE file LIKE '%.tif' OR file LIKE '%.tiff'),
j AS (SELECT sample_id, format, file, CASE WHEN file IS NULL THEN 'no TIFF file found' WHEN single AND NOT (file LIKE '%.tif' OR file LIKE '%.tiff') THEN 'not a TIFF file' END AS error FROM asked LEFT JOIN known USING (asked))
SELECT sample_id, format, CASE WHEN error IS NULL THEN file END AS path, error FROM j""")
def s3_expand_files(spark, d):
    m = views.manifest(spark, d)
    path = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("/data/"), (F.col("row_id") % 70).cast("string"))).otherwise(F.coalesce("path", F.lit("/none")))
    asked = m.select(F.concat(F.lit("s"), F.col("row_id").cast("string")).alias("sample_id"), path.alias("path"), F.lit("tiles").alias("format"))
    return manifest.expand_files(asked, m.where("path is not null").select("path").distinct())


@query("SELECT p_partkey, p_partkey % 6 IN (0, 1, 2, 3) AS is_tiff FROM part")
def s4_check_tiff_magic(spark, d):
    starts = F.array(*map(F.lit, [*manifest.MAGIC, "89504E470D0A", "49492A"]))
    p = views.table(spark, d, "part").select("p_partkey", F.unhex(F.element_at(starts, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("content"))
    return manifest.check_tiff_magic(p).drop("content")


@query(f"WITH {MANIFEST} SELECT DISTINCT 'run' AS sample, regexp_extract(path, '^(.*/)?[^/]*$', 1) || translate(regexp_extract(path, '([^/]*)$', 1), ' [],', '____') AS tiffs FROM manifest WHERE path LIKE '%.tif'")
def s9_build_manifest(spark, d):
    return manifest.build_manifest(views.manifest(spark, d).select("path"), "run")


@query("""WITH n AS (SELECT p_partkey, unnest([p_name, p_brand, p_type, '.' || p_size, p_size || p_name, 'if', ' x ', '.a']) AS name FROM part),
c AS (SELECT *, regexp_replace(name, '[^\\p{L}\\p{N}._]', '.', 'g') AS clean FROM n),
x AS (SELECT *, CASE WHEN regexp_matches(name, '^(\\p{L}|\\.$|\\.[^\\p{N}])') THEN clean ELSE 'X' || clean END AS led FROM c)
SELECT p_partkey, name, trim(CASE WHEN led IN ('if', 'else', 'for', 'in', 'next', 'break', 'while', 'repeat', 'function') THEN led || '.' ELSE led END) AS valid FROM x""")
def f1_make_names(spark, d):
    c = F.col
    names = F.array("p_name", "p_brand", "p_type", F.concat(F.lit("."), c("p_size").cast("string")), F.concat(c("p_size").cast("string"), "p_name"), F.lit("if"), F.lit(" x "), F.lit(".a"))
    return views.table(spark, d, "part").select("p_partkey", F.explode(names).alias("name")).withColumn("valid", scalar.make_names(c("name")))


@query(f"WITH {MANIFEST} SELECT row_id, translate(path, ' [],', '____') AS clean, path LIKE '%.tif' OR path LIKE '%.tiff' AS is_tiff, contains(upper(path), upper('F 1')) AS has_f1 FROM manifest")
def f2_f3_f4_path_functions(spark, d):
    p = F.col("path")
    return views.manifest(spark, d).select("row_id", scalar.clean_file_name(p).alias("clean"), scalar.is_tiff_path(p).alias("is_tiff"), scalar.contains_ci(p, F.lit("f 1")).alias("has_f1"))


@query("SELECT l_orderkey, l_linenumber, floor(l_quantity / 4 + 0.5)::BIGINT AS half_up, round_even(l_quantity / 4, 0) AS half_even, greatest(least(l_quantity - 10, 20.0), 0.0) AS clipped, CASE WHEN l_quantity = 13 THEN 0.0 ELSE l_quantity END AS filled FROM lineitem")
def f8_f9_f10_number_functions(spark, d):
    q = F.col("l_quantity")
    filled = F.coalesce(F.when(q != 13, q), F.lit(0.0))
    return views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", scalar.round_half_up(q / 4).alias("half_up"), scalar.round_half_even(q / 4).alias("half_even"), scalar.clip(q - 10, 0, 20).alias("clipped"), filled.alias("filled"))


# -- metadata ---------------------------------------------------------------------------------------------------------


@query(f"WITH {CHANNELS} SELECT sample_id, (row_number() OVER (PARTITION BY sample_id ORDER BY channel) - 1)::INT AS channel, CASE WHEN channel = 2 THEN '' ELSE name END AS name, 0.5 + sample_id::INT AS physical_size_x FROM channels")
def f5_parse_ome_xml(spark, d):
    ch = views.channels(spark, d)
    tag = F.concat(F.lit('<Channel ID="Channel:'), F.col("channel").cast("string"), F.lit('"'), F.when(F.col("channel") != 2, F.concat(F.lit(' Name="'), "name", F.lit('"'))).otherwise(""), F.lit("/>"))
    tags = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("channel", tag.alias("t")))), lambda x: x["t"]), "")
    size = (F.col("sample_id").cast("int") + 0.5).cast("string")
    xml = F.concat(F.lit('<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels SizeX="8" SizeY="8" PhysicalSizeX="'), size, F.lit('" PhysicalSizeY="'), size, F.lit('">'), "tags", F.lit("</Pixels></Image></OME>"))
    images = ch.groupBy("sample_id").agg(tags.alias("tags")).select("sample_id", xml.alias("xml"))
    parsed = meta.parse_ome_xml(images)
    return meta.channels_of(parsed).join(parsed.select("sample_id", "physical_size_x"), "sample_id")


@query(f"WITH {CHANNELS} SELECT sample_id, (row_number() OVER (PARTITION BY sample_id ORDER BY channel) - 1)::INT AS channel, name, {r('1.0 / (2 + sample_id::INT)')} AS um_per_px FROM channels")
def f6_parse_vendor_xml(spark, d):
    ch = views.channels(spark, d)
    tag = F.concat(F.lit('<channel name="'), "name", F.lit('"/>'))
    tags = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("channel", tag.alias("t")))), lambda x: x["t"]), "")
    images = ch.groupBy("sample_id").agg(F.concat(F.lit("<image>"), tags, F.lit("</image>")).alias("xml")).withColumn("res", F.col("sample_id").cast("int") + 2)
    return meta.parse_vendor_xml(images, resolution="res").select("sample_id", F.posexplode("channel_names").alias("channel", "name"), "um_per_px")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN [p_partkey, 4]::VARCHAR ELSE [3, p_partkey, 4]::VARCHAR END AS shape, p_brand = 'Brand#2' AS ok FROM part")
def f7_infer_plane_shape(spark, d):
    c = F.col
    shape = F.when(c("p_size") % 2 == 0, F.array("p_partkey", F.lit(4).cast("long"))).otherwise(F.array("p_partkey", F.lit(4).cast("long"), F.lit(3).cast("long")))
    axes = F.when(c("p_brand") == "Brand#2", "CYX").otherwise("ZYX")
    out = meta.infer_plane_shape(shape, c("p_partkey"), F.lit(4).cast("long"), F.lit(3).cast("long"))
    return views.table(spark, d, "part").select("p_partkey", out.cast("string").alias("shape"), meta.plane_axes_ok(axes).alias("ok"))


@query(f"WITH {CHANNELS} SELECT sample_id, min(channel) FILTER (contains(upper(name), 'RED')) AS channel FROM channels GROUP BY sample_id")
def t2_first_match(spark, d):
    return meta.first_match(views.channels(spark, d), "red")


P2_PIXELS = "SELECT (l_partkey // 5)::VARCHAR AS sample_id, (l_orderkey % 5)::INT AS channel, l_orderkey, l_linenumber FROM lineitem"


@query(f"WITH {CHANNELS}, t AS ({P2_PIXELS}), f AS (SELECT sample_id, min(channel) AS channel FROM channels WHERE contains(upper(name), 'RED') GROUP BY ALL) SELECT t.* FROM t SEMI JOIN f USING (sample_id, channel)")
def p2_extract_channel(spark, d):
    t = views.table(spark, d, "lineitem").select(F.floor(F.col("l_partkey") / 5).cast("string").alias("sample_id"), (F.col("l_orderkey") % 5).cast("int").alias("channel"), "l_orderkey", "l_linenumber")
    return meta.extract_channel(t, views.channels(spark, d), "red").select("sample_id", "channel", "l_orderkey", "l_linenumber")


MATCH = f"""{CHANNELS}, {views.TYPE_SHEET},
k AS (SELECT s.sample_id, marker_name, marker_idx, min(channel) AS channel, count(channel) AS n_matches FROM (SELECT DISTINCT sample_id FROM channels) s CROSS JOIN m LEFT JOIN channels c ON c.sample_id = s.sample_id AND contains(upper(name), upper(marker_name)) GROUP BY ALL),
picked AS (SELECT *, CASE WHEN channel IS NOT NULL THEN count(channel) OVER (PARTITION BY sample_id ORDER BY marker_idx) - 1 END AS new_channel FROM k)"""


@query(f"WITH {MATCH} SELECT sample_id, marker_name, marker_idx, channel, n_matches, new_channel FROM picked")
def p3_match_channels(spark, d):
    return meta.match_channels(views.channels(spark, d), views.type_sheet(spark, d))


@query(f"WITH {MATCH}, t AS ({P2_PIXELS}) SELECT t.sample_id, picked.new_channel::INT AS channel, l_orderkey, l_linenumber FROM t JOIN picked USING (sample_id, channel)")
def p3_select_channels(spark, d):
    t = views.table(spark, d, "lineitem").select(F.floor(F.col("l_partkey") / 5).cast("string").alias("sample_id"), (F.col("l_orderkey") % 5).cast("int").alias("channel"), "l_orderkey", "l_linenumber")
    return meta.select_channels(t, views.channels(spark, d), views.type_sheet(spark, d)).select("sample_id", "channel", "l_orderkey", "l_linenumber")


@query("SELECT s_suppkey, floor(s_acctbal / (s_nationkey % 5) * (s_suppkey / 8.0) + 0.5)::BIGINT AS x, floor(s_acctbal / 4 * (s_suppkey / 16.0) + 0.5)::BIGINT AS y, 64 AS width, 32 AS height FROM supplier WHERE s_nationkey % 5 <> 0")
def p6_tile_regions(spark, d):
    c = F.col
    t = views.table(spark, d, "supplier").select("s_suppkey", meta.rational(c("s_acctbal"), c("s_nationkey") % 5).alias("x_res"), (c("s_acctbal") / 4).alias("y_res"), (c("s_suppkey") / 8.0).alias("x_pos"), (c("s_suppkey") / 16.0).alias("y_pos"), F.lit(64).alias("width"), F.lit(32).alias("height"))
    return meta.tile_regions(t).select("s_suppkey", "x", "y", "width", "height")


AXES = "CASE WHEN contains(upper(axes), 'X') AND contains(upper(axes), 'Y') THEN regexp_replace(upper(axes), '[^TCZYX]', 'C', 'g') ELSE CASE WHEN shape[3] IN (3, 4) THEN 'YXC' ELSE 'ZYX' END END"
ANALYSED = f"""{LEVELS}, l AS (SELECT *, {AXES} AS a FROM levels),
z AS (SELECT *, floor(first_value(shape[instr(a, 'X')]) OVER w / shape[instr(a, 'X')] + 0.5) AS scale, first_value(physical_size_x) OVER w AS base FROM l WINDOW w AS (PARTITION BY sample_id ORDER BY level)),
analysed AS (SELECT sample_id, level, a AS axes, scale, base * scale AS eff, floor(1.0 / (base * scale) + 0.5) AS k, base * scale * floor(1.0 / (base * scale) + 0.5) AS final, abs(base * scale * floor(1.0 / (base * scale) + 0.5) - 1.0) AS err FROM z)"""


@query(f"WITH {LEVELS} SELECT sample_id, level, {AXES} AS axes FROM levels")
def p10_detect_axes(spark, d):
    return views.levels(spark, d).select("sample_id", "level", meta.detect_axes(F.col("axes"), F.col("shape")).alias("axes"))


@query(f"WITH {ANALYSED} SELECT sample_id, level, axes, scale::BIGINT AS scale, {r('eff')} AS eff, k::BIGINT AS k, {r('final')} AS final, {r('err')} AS err FROM analysed")
def p9_analyze_levels(spark, d):
    return meta.analyze_levels(views.levels(spark, d)).select("sample_id", "level", "axes", "scale", "eff", "k", "final", "err")


@query(f"""WITH RECURSIVE {ANALYSED}, fold AS (
SELECT sample_id, -1 AS seen, 0 AS level, 0.0::DOUBLE AS k, 'inf'::DOUBLE AS err, true AS scaled, false AS done FROM analysed WHERE level = 0
UNION ALL
SELECT f.sample_id, f.seen + 1, CASE WHEN take THEN a.level ELSE f.level END, CASE WHEN take THEN a.k ELSE f.k END, CASE WHEN take THEN a.err ELSE f.err END, CASE WHEN take THEN a.k <> 1 ELSE f.scaled END, CASE WHEN take THEN a.err <= 0.15 AND a.k = 1 ELSE f.done END
FROM (SELECT f.*, a.level AS al, NOT f.done AND a.k IS NOT NULL AND a.k <> 0 AND ((a.err <= 0.15 AND a.k = 1) OR a.err < f.err - 0.1 OR (abs(a.err - f.err) < 0.1 AND ((a.k = 1 AND f.scaled) OR ((a.k <> 1) = f.scaled AND a.level > f.level)))) AS take
  FROM fold f JOIN analysed a ON a.sample_id = f.sample_id AND a.level = f.seen + 1) f JOIN analysed a ON a.sample_id = f.sample_id AND a.level = f.al),
last AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY seen DESC) = 1)
SELECT sample_id, level::INT AS level, CASE WHEN k <> 0 THEN k END AS k,
  CASE WHEN sample_id IN (SELECT sample_id FROM analysed WHERE k IS NULL) THEN 'no physical size' WHEN k = 0 THEN 'no level can be scaled to the target' END AS message FROM last""")
def p10b_select_level(spark, d):
    return meta.select_level(meta.analyze_levels(views.levels(spark, d)))


@query(f"""WITH {ANALYSED} SELECT l.sample_id, l.level, shape[instr(a.axes, 'X')]::INT AS size_x, CASE WHEN contains(a.axes, 'C') THEN 5 ELSE 1 END AS size_c, CASE WHEN contains(a.axes, 'Z') THEN 5 ELSE 1 END AS size_z, {r('l.physical_size_x * 2')} AS physical_size_x,
CASE WHEN contains(a.axes, 'C') THEN 'Channel:0,Channel:1,Channel:2,Channel:3,Channel:4' ELSE 'one' END AS channel_names FROM levels l JOIN analysed a USING (sample_id, level)""")
def p12b_update_image_metadata(spark, d):
    lv = views.levels(spark, d)
    lv = lv.withColumn("axes", meta.detect_axes(F.col("axes"), F.col("shape"))).withColumn("physical_size_y", F.col("physical_size_x")).withColumn("channel_names", F.array(F.lit("one"))).withColumn("k", F.lit(2))
    out = meta.update_image_metadata(lv)
    return out.select("sample_id", "level", "size_x", "size_c", "size_z", "physical_size_x", F.array_join("channel_names", ",").alias("channel_names"))


@query(f"WITH {LEVELS} SELECT sample_id, '{{\"level\":' || level || ',\"shape\":[' || array_to_string(shape, ',') || ']}}' AS json FROM levels")
def s8_scale_metadata_json(spark, d):
    return meta.scale_metadata_json(views.levels(spark, d), ["level", "shape"])


# -- pixels -----------------------------------------------------------------------------------------------------------


def _dirty(spark, d):
    v = F.col("value")
    return views.pixels(spark, d).withColumn("value", F.when(v > 0.2, float("inf")).when(v < -0.2, float("nan")).otherwise(v))


@query(f"WITH {PIXELS} SELECT sample_id, y, x, {r('CASE WHEN abs(value) > 0.2 THEN 0.0 ELSE value END')} AS value FROM pixels")
def p1_clean_nonfinite(spark, d):
    return pixels.clean_nonfinite(_dirty(spark, d)).select("sample_id", "y", "x", "value")


@query(f"WITH {PIXELS} SELECT sample_id, count(*) FILTER (abs(value) > 0.2) AS n_nonfinite FROM pixels GROUP BY sample_id")
def p1_count_nonfinite(spark, d):
    return pixels.count_nonfinite(_dirty(spark, d))


@query(f"WITH {PIXELS} SELECT sample_id, channel AS y, y AS x, x AS channel, {r('value')} AS value FROM pixels")
def p4_permute_axes(spark, d):
    return pixels.permute_axes(views.pixels(spark, d), (2, 0, 1))


@query(f"WITH {PLAIN} SELECT sample_id, 1 - mirror AS channel, y, CASE mirror WHEN 1 THEN 63 - x ELSE x END AS x, {r('value')} AS value FROM plain, range(0, 2) AS m(mirror)")
def p5_stack_channels(spark, d):
    return pixels.stack_channels(views.pixels(spark, d), views.pixels(spark, d, True))


STITCH = "t AS (SELECT sample_id, 't' || (y // 50) AS path, channel, y % 50 AS y, x, value FROM pixels)"


@query(f"WITH {PIXELS}, {STITCH}, p AS (SELECT sample_id, channel, y + 45 * substr(path, 2)::INT AS y, x + 3 * substr(path, 2)::INT AS x, value, path FROM t) SELECT sample_id, channel, y::INT AS y, x::INT AS x, {r('arg_min(value, path)')} AS value FROM p GROUP BY ALL")
def p7_stitch(spark, d):
    return pixels.stitch(*_fields(spark, d))


def _fields(spark, d):
    """Images cut into fields of 50 rows that overlap by five on the canvas, and their places."""
    px = views.pixels(spark, d)
    tile = F.floor(F.col("y") / 50)
    tiles = px.withColumn("path", F.concat(F.lit("t"), tile.cast("string"))).withColumn("y", F.col("y") % 50)
    regions = px.select("sample_id", tile.alias("i")).distinct().select("sample_id", F.concat(F.lit("t"), F.col("i").cast("string")).alias("path"), (F.col("i") * 3 + 7).alias("x"), (F.col("i") * 45 + 5).alias("y"))
    return tiles, regions


@query(f"WITH {PIXELS}, {STITCH}, p AS (SELECT sample_id, channel, y + 45 * substr(path, 2)::INT AS y, x + 3 * substr(path, 2)::INT AS x, value, path FROM t) SELECT sample_id, channel, y::INT AS y, x::INT AS x, {r('arg_min(value, path)')} AS value FROM p GROUP BY ALL")
def p7_stitch_tiles(spark, d):
    """Block form: fields come as blocks of 16, the canvas as blocks of 32. Its gaps, which are 0 there, are left out."""
    fields, regions = _fields(spark, d)
    canvas = blocks.stitch_tiles(pixels.to_tiles(fields, 16, by=("sample_id", "path", "channel")), regions, 32)
    ends = regions.join(fields.groupBy("sample_id", "path").agg(F.max("y").alias("h"), F.max("x").alias("w")), ["sample_id", "path"])
    inside = ends.select("sample_id", (F.col("y") - 5).alias("top"), (F.col("y") - 5 + F.col("h")).alias("end"), (F.col("x") - 7).alias("left"), (F.col("x") - 7 + F.col("w")).alias("side"))
    rects = inside.groupBy("sample_id").agg(F.collect_list(F.struct("top", "end", "left", "side")).alias("rects"))
    within = F.exists("rects", lambda q: F.col("y").between(q["top"], q["end"]) & F.col("x").between(q["left"], q["side"]))
    return pixels.to_pixels(canvas).join(rects, "sample_id").where(within).drop("rects")


def _scaled(k: int, value: str = "value") -> str:
    return f"SELECT sample_id, channel, (y // {k})::INT AS y, (x // {k})::INT AS x, avg({value}) AS value FROM pixels JOIN (SELECT sample_id, max(y) + 1 AS hh, max(x) + 1 AS ww FROM pixels GROUP BY ALL) USING (sample_id) WHERE y < hh // {k} * {k} AND x < ww // {k} * {k} GROUP BY ALL"


@query(f"WITH {PIXELS}, s AS ({_scaled(3, 'round_even(value * 100, 0)')}) SELECT sample_id, channel, y, x, round_even(value, 0) + 0.0 AS value FROM s")
def p11_downscale(spark, d):
    return pixels.downscale(views.pixels(spark, d).withColumn("value", F.rint(F.col("value") * 100)), 3, integer=True)


@query(f"WITH {PIXELS}, s AS ({_scaled(2)}) SELECT sample_id, channel, y, x, {r('value')} AS value FROM s")
def p11_downscale_tiles(spark, d):
    """Block form, by blocks of 50 x 50: no pixel is shuffled to be averaged."""
    return pixels.to_pixels(pixels.downscale_tiles(pixels.to_tiles(views.pixels(spark, d), 50), 2))


@query(f"WITH {PIXELS} SELECT sample_id, 0 AS level, channel, y, x, {r('value')} AS value FROM pixels UNION ALL SELECT sample_id, 1, channel, y, x, {r('value')} FROM ({_scaled(2)}) UNION ALL SELECT sample_id, 2, channel, y, x, {r('value')} FROM ({_scaled(4)})")
def p8_build_pyramid(spark, d):
    return pixels.build_pyramid(views.pixels(spark, d), (1, 2, 4))


@query(f"WITH {PIXELS} SELECT sample_id, 0 AS level, channel, y, x, {r('value')} AS value FROM pixels UNION ALL SELECT sample_id, 1, channel, y, x, {r('value')} FROM ({_scaled(2)}) UNION ALL SELECT sample_id, 2, channel, y, x, {r('value')} FROM ({_scaled(4)})")
def p8_pyramid_tiles(spark, d):
    """Block form: each level from the blocks of the one before."""
    return pixels.to_pixels(blocks.pyramid_tiles(pixels.to_tiles(views.pixels(spark, d), 32), (1, 2, 4), 32))


@query(f"WITH {PIXELS} SELECT sample_id, channel, y, x, {r('greatest(value - avg(value) OVER (PARTITION BY sample_id, channel), 0.0)')} AS value FROM pixels")
def p13a_bg_mean(spark, d):
    return pixels.bg_mean(views.pixels(spark, d))


@query(f"WITH {PLAIN} SELECT sample_id, 0 AS channel, y, x, {r('greatest(value - other, 0.0)')} AS value FROM plain")
def p13b_bg_af(spark, d):
    return pixels.bg_af(views.pixels(spark, d), views.pixels(spark, d, True))


GAUSS = f"""WITH {PIXELS}, k AS (SELECT o, exp(-0.5 * o * o) / (SELECT sum(exp(-0.5 * i * i)) FROM range(-4, 5) AS g(i)) AS w FROM range(-4, 5) AS g(o)),
size AS (SELECT sample_id, max(y) AS my, max(x) AS mx FROM pixels GROUP BY ALL),
a AS (SELECT p.sample_id, p.y, p.x, sum(w * q.value) AS v FROM pixels p JOIN size s USING (sample_id) CROSS JOIN k JOIN pixels q ON q.sample_id = p.sample_id AND q.x = p.x AND q.y = greatest(0, least(s.my, p.y + o)) GROUP BY ALL),
b AS (SELECT p.sample_id, p.y, p.x, sum(w * q.v) AS v FROM a p JOIN size s USING (sample_id) CROSS JOIN k JOIN a q ON q.sample_id = p.sample_id AND q.y = p.y AND q.x = greatest(0, least(s.mx, p.x + o)) GROUP BY ALL)
SELECT sample_id, y, x, {r('greatest(value - v, 0.0)')} AS value FROM pixels JOIN b USING (sample_id, y, x)"""


@query(GAUSS)
def p13c_bg_gaussian(spark, d):
    tiles = pixels.to_tiles(views.pixels(spark, d), 24)
    return pixels.to_pixels(halo.bg_gaussian(tiles, sigma=1, size=24)).select("sample_id", "y", "x", "value")


@query(f"""WITH {PIXELS}, o AS (SELECT dy, dx, 3 - sqrt(9 - dy * dy - dx * dx) AS depth FROM range(-3, 4) AS a(dy), range(-3, 4) AS b(dx) WHERE dy * dy + dx * dx <= 9),
s AS MATERIALIZED (SELECT sample_id, y, x, y + dy AS qy, x + dx AS qx, depth FROM pixels CROSS JOIN o),
b AS (SELECT s.sample_id, s.y, s.x, min(q.value + depth) AS low FROM s JOIN pixels q ON q.sample_id = s.sample_id AND q.y = s.qy AND q.x = s.qx GROUP BY ALL)
SELECT sample_id, y, x, {r('greatest(value - low, 0.0)')} AS value FROM pixels JOIN b USING (sample_id, y, x)""")
def p13d_bg_rollingball(spark, d):
    tiles = pixels.to_tiles(views.pixels(spark, d), 24)
    return pixels.to_pixels(halo.bg_rollingball(tiles, radius=3, size=24)).select("sample_id", "y", "x", "value")


EDGES = MASK + """, m AS MATERIALIZED (SELECT *, y + dy AS qy, x + dx AS qx FROM mask CROSS JOIN range(-1, 2) AS a(dy) CROSS JOIN range(-1, 2) AS b(dx)), n AS (SELECT m.sample_id, m.y, m.x, any_value(m.cell_id) AS own, min(q.cell_id) FILTER (abs(q.y - m.y) + abs(q.x - m.x) <= 1) AS low4, max(q.cell_id) FILTER (abs(q.y - m.y) + abs(q.x - m.x) <= 1) AS high4,
  count(DISTINCT q.cell_id) FILTER (q.cell_id <> 0) AS labels FROM m JOIN mask q ON q.sample_id = m.sample_id AND q.y = m.qy AND q.x = m.qx GROUP BY m.sample_id, m.y, m.x),
edges AS (SELECT sample_id, y, x, CASE WHEN low4 <> high4 AND (own = 0 OR labels > 1) THEN 255 ELSE 0 END AS value FROM n)"""


@query(f"WITH {EDGES} SELECT sample_id, 0 AS plane, y, x, value FROM edges")
def p14_outer_boundaries(spark, d):
    return pixels.outer_boundaries(views.mask(spark, d))


# The same boundaries by shifts of whole rows: a label and those around it from windows over the image's rows and columns.
SHIFTED = """plain AS (SELECT 'img' || (vec_id // 250)::VARCHAR AS sample_id, (vec_id % 250)::INT AS y, unnest(embedding)::DOUBLE AS value, (generate_subscripts(embedding, 1) - 1)::INT AS x FROM embeddings),
m AS (SELECT *, CASE WHEN value > 0 THEN y // 5 * 13 + x // 5 + 1 ELSE 0 END AS c FROM plain),
rows3 AS (SELECT *, lag(c) OVER w AS up, lead(c) OVER w AS down FROM m WINDOW w AS (PARTITION BY sample_id, x ORDER BY y)),
nine AS (SELECT *, [c, up, down] AS mid, [lag(c) OVER w, lag(up) OVER w, lag(down) OVER w] AS lft, [lead(c) OVER w, lead(up) OVER w, lead(down) OVER w] AS rgt FROM rows3 WINDOW w AS (PARTITION BY sample_id, y ORDER BY x)),
edges AS (SELECT sample_id, y, x, value, list_filter([c, up, down, lft[1], rgt[1]], lambda v: v IS NOT NULL) AS four, len(list_distinct(list_filter(list_concat(mid, lft, rgt), lambda v: v > 0))) AS labels, c FROM nine),
lines AS (SELECT sample_id, y, x, value, CASE WHEN list_min(four) <> list_max(four) AND (c = 0 OR labels > 1) THEN 255.0 ELSE 0.0 END::DOUBLE AS line FROM edges)"""


@query(f"WITH {SHIFTED} SELECT sample_id, k::INT AS channel, y, x, CASE k WHEN 0 THEN {r('value')} ELSE line END AS value FROM lines, range(0, 2) AS g(k)")
def p15_bw_overlay(spark, d):
    return pixels.bw_overlay(views.pixels(spark, d), pixels.outer_boundaries(views.mask(spark, d)))


@query(f"WITH {EDGES}, q AS (SELECT sample_id, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.995) AS hi FROM pixels GROUP BY ALL) SELECT sample_id, y, x, CASE WHEN e.value > 0 THEN 255 ELSE 0 END AS r, 0 AS g, trunc(greatest(least((p.value - lo) / (hi - lo) * 255, 255.0), 0.0))::INT AS b FROM pixels p JOIN q USING (sample_id) JOIN edges e USING (sample_id, y, x)")
def p16_rgb_overlay(spark, d):
    return pixels.rgb_overlay(views.pixels(spark, d), pixels.outer_boundaries(views.mask(spark, d)))


HIST = PIXELS + """, e AS (SELECT sample_id, min(value) AS lo, max(value) AS hi FROM pixels GROUP BY ALL),
h AS (SELECT sample_id, least(floor((value - lo) / (hi - lo) * 256), 255) AS bin, any_value(lo) AS lo, any_value((hi - lo) / 256) AS wide, count(*) AS n FROM pixels JOIN e USING (sample_id) GROUP BY ALL),
c AS (SELECT sample_id, bin, lo + (bin + 0.5) * wide AS centre, n FROM h)"""
OTSU = HIST + """, v AS (SELECT *, sum(n) OVER a AS w1, sum(n) OVER b AS w2, sum(n * centre) OVER a AS s1, sum(n * centre) OVER b AS s2 FROM c
WINDOW a AS (PARTITION BY sample_id ORDER BY bin ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY sample_id ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
t AS (SELECT sample_id, centre AS threshold FROM v QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY coalesce(w1 * w2 * pow(s1 / w1 - s2 / w2, 2), -1) DESC, bin) = 1)"""


@query(f"WITH {OTSU} SELECT sample_id, {r('threshold')} AS threshold, {r('threshold * 0.9')} AS adjusted FROM t")
def p17_otsu(spark, d):
    return pixels.otsu(views.pixels(spark, d), 0.1)


@query(f"WITH {OTSU} SELECT sample_id, channel, y, x, CASE WHEN value > threshold * 0.9 THEN 255 ELSE 0 END AS value FROM pixels JOIN t USING (sample_id)")
def p18_binarise(spark, d):
    px = views.pixels(spark, d)
    return pixels.binarise(px, pixels.otsu(px, 0.1))


@query(f"WITH {HIST} SELECT sample_id, bin::BIGINT AS bin, {r('centre')} AS centre, n FROM c")
def p19_intensity_histogram(spark, d):
    return pixels.intensity_histogram(views.pixels(spark, d))


@query(f"WITH {PIXELS}, b AS (SELECT * FROM pixels WHERE sample_id <> 'img0' OR x < 60), s AS (SELECT sample_id, max(y) + 1 AS h, max(x) + 1 AS w FROM pixels GROUP BY ALL), t AS (SELECT sample_id, max(y) + 1 AS h, max(x) + 1 AS w FROM b GROUP BY ALL) SELECT sample_id, s.h AS height_a, s.w AS width_a, t.h AS height_b, t.w AS width_b FROM s JOIN t USING (sample_id) WHERE s.h <> t.h OR s.w <> t.w")
def v5_check_shapes(spark, d):
    px = views.pixels(spark, d)
    return pixels.check_shapes(px, px.where("sample_id <> 'img0' or x < 60"))


@query(f"WITH {PIXELS} SELECT DISTINCT sample_id || '-' || x AS sample_id FROM pixels WHERE x % 2 = 0")
def v6_check_not_blank(spark, d):
    """Every second column of the images is blanked and looked at as an image of its own."""
    px = views.pixels(spark, d)
    own = px.select(F.concat_ws("-", "sample_id", F.col("x").cast("string")).alias("sample_id"), F.when(F.col("x") % 2 == 0, float("nan")).otherwise(F.col("value")).alias("value"))
    return pixels.check_not_blank(own)


# -- quantification ---------------------------------------------------------------------------------------------------


def _blocks(spark, d):
    stack = pixels.stack_channels(views.pixels(spark, d), views.pixels(spark, d, True))
    labels = views.mask(spark, d).withColumn("channel", F.lit(0))
    return pixels.to_tiles(stack, 32), pixels.to_tiles(labels, 32, "cell_id")


INTENSITY = MASK + ", i AS (SELECT sample_id, cell_id, channel, avg(value) AS value FROM (SELECT sample_id, y, x, 1 AS channel, value FROM pixels UNION ALL SELECT sample_id, y, x, 0, value FROM mirrored) JOIN mask USING (sample_id, y, x) WHERE cell_id > 0 GROUP BY ALL)"


@query(f"WITH {INTENSITY} SELECT sample_id, cell_id::INT AS cell_id, channel, {r('value')} AS value FROM i")
def q1_cell_intensity(spark, d):
    return quantify.cell_intensity(*_blocks(spark, d))


SHAPE = MASK + """, m AS (SELECT sample_id, cell_id, count(*)::DOUBLE AS area, avg(x) AS xc, avg(y) AS yc, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS c, (max(x) - min(x) + 1) * (max(y) - min(y) + 1) AS box FROM mask WHERE cell_id > 0 GROUP BY ALL),
e AS (SELECT *, (vx + vy) / 2 + sqrt(pow((vx - vy) / 2, 2) + c * c) AS l1, greatest((vx + vy) / 2 - sqrt(pow((vx - vy) / 2, 2) + c * c), 0.0) AS l2 FROM m)"""


@query(f"""WITH {SHAPE} SELECT sample_id, cell_id::INT AS cell_id, {r('xc')} AS "X_centroid", {r('yc')} AS "Y_centroid", area AS "Area", {r('4 * sqrt(l1)')} AS "MajorAxisLength", {r('4 * sqrt(l2)', 3)} AS "MinorAxisLength",
{r('area / box')} AS "Extent" FROM e""")
def q2_cell_morphology(spark, d):
    """Without eccentricity and orientation: of nearly degenerate cells they hang on the last bits; tests hold them."""
    out = quantify.cell_morphology(views.mask(spark, d))
    return out.select("sample_id", "cell_id", "X_centroid", "Y_centroid", "Area", "MajorAxisLength", F.round("MinorAxisLength", 3).alias("MinorAxisLength"), "Extent")


# The hull's width at each line between rows is the most that two row ends reach to each other; between lines it is linear.
HULL = MASK + """, sides AS (SELECT sample_id, cell_id, y, max(x) + 0.5 AS right_end, 0.5 - min(x) AS left_end, count(*) AS n FROM mask WHERE cell_id > 0 GROUP BY ALL),
corners AS (SELECT sample_id, cell_id, y + e - 0.5 AS y, max(right_end) AS r, max(left_end) AS l FROM sides, range(0, 2) AS g(e) GROUP BY ALL),
lines AS (SELECT m.sample_id, m.cell_id, m.y, max(CASE WHEN a.y = b.y THEN a.r ELSE a.r + (b.r - a.r) * (m.y - a.y) / (b.y - a.y) END) AS r, max(CASE WHEN a.y = b.y THEN a.l ELSE a.l + (b.l - a.l) * (m.y - a.y) / (b.y - a.y) END) AS l
FROM corners m JOIN corners a ON a.sample_id = m.sample_id AND a.cell_id = m.cell_id AND a.y <= m.y JOIN corners b ON b.sample_id = m.sample_id AND b.cell_id = m.cell_id AND b.y >= m.y GROUP BY ALL),
strips AS (SELECT sample_id, cell_id, y - lag(y) OVER w AS high, (r + l + lag(r) OVER w + lag(l) OVER w) / 2 AS wide FROM lines WINDOW w AS (PARTITION BY sample_id, cell_id ORDER BY y)),
hull AS (SELECT sample_id, cell_id, sum(high * wide) AS area FROM strips GROUP BY ALL)"""


@query(f"WITH {HULL}, c AS (SELECT sample_id, cell_id, sum(n) AS n FROM sides GROUP BY ALL) SELECT sample_id, cell_id::INT AS cell_id, {r('n / area')} AS Solidity FROM c JOIN hull USING (sample_id, cell_id)")
def q3_cell_solidity(spark, d):
    return quantify.cell_solidity(views.mask(spark, d))


@query(f"""WITH {INTENSITY}, a AS (SELECT sample_id, cell_id, count(*)::DOUBLE AS area FROM mask WHERE cell_id > 0 GROUP BY ALL) SELECT sample_id, cell_id::INT AS cell_id, {r('max(value) FILTER (channel = 0)')} AS "c0", {r('max(value) FILTER (channel = 1)')} AS "c1", any_value(area) AS "Area" FROM i JOIN a USING (sample_id, cell_id) GROUP BY ALL""")
def q4_cell_table(spark, d):
    intensity = quantify.cell_intensity(*_blocks(spark, d)).withColumn("marker", F.concat(F.lit("c"), F.col("channel").cast("string")))
    return quantify.cell_table(intensity, quantify.cell_morphology(views.mask(spark, d)), ["c0", "c1"]).select("sample_id", "cell_id", "c0", "c1", "Area")


@query(f"WITH {PLAIN} SELECT sample_id, y, x, {r('value')} AS value, {r('other')} AS af FROM plain")
def j1_join_by_sample(spark, d):
    af = views.pixels(spark, d, True).select("sample_id", "y", "x", F.col("value").alias("af"))
    return quantify.join_by_sample(views.pixels(spark, d), af, ("sample_id", "y", "x")).select("sample_id", "y", "x", "value", "af")


@query(f"WITH {MASK} SELECT sample_id, 'seg' || s AS seg, c::INT AS channel, y // 32 AS ty, x // 32 AS tx, count(*) AS n_pixels, count(*) FILTER (cell_id > 0) AS n_labelled FROM mask, range(0, 2) AS g(s), range(0, 2) AS h(c) GROUP BY ALL")
def j2_combine_mask_image(spark, d):
    tiles, labels = _blocks(spark, d)
    seg = labels.withColumn("seg", F.explode(F.array(F.lit("seg0"), F.lit("seg1"))))
    both = quantify.combine_mask_image(seg, tiles)
    return both.select("sample_id", "seg", "channel", "ty", "tx", F.size("values").cast("long").alias("n_pixels"), F.size(F.filter("labels", lambda x: x > 0)).cast("long").alias("n_labelled"))


@query(f"WITH {PLAIN} SELECT sample_id, y, x, {r('value')} AS value, CASE WHEN x > 9 THEN {r('other')} END AS membrane FROM plain")
def j3_pair_images(spark, d):
    membrane = views.pixels(spark, d, True).where("x > 9").select("sample_id", "y", "x", F.col("value").alias("membrane"))
    return quantify.pair_images(views.pixels(spark, d), membrane, ("sample_id", "y", "x")).select("sample_id", "y", "x", "value", "membrane")


@query(f"WITH {CHANNELS} SELECT c.sample_id, c.channel, r_name AS marker_name, r_regionkey AS marker_idx FROM channels c CROSS JOIN region")
def j4_attach_markers(spark, d):
    sheet = views.table(spark, d, "region").select(F.col("r_name").alias("marker_name"), F.col("r_regionkey").alias("marker_idx"))
    return meta.attach_markers(views.channels(spark, d).drop("name"), sheet)


@query(f"""WITH {PIXELS}, two AS (SELECT sample_id, y, x, 1 AS channel, value FROM pixels UNION ALL SELECT sample_id, y, x, 0, value FROM mirrored),
ends AS (SELECT sample_id, max(y) + 1 AS hh, max(x) + 1 AS ww FROM pixels GROUP BY ALL),
s AS MATERIALIZED (SELECT sample_id, channel, y // 2 AS y, x // 2 AS x, avg(value) AS value FROM two JOIN ends USING (sample_id) WHERE y < hh // 2 * 2 AND x < ww // 2 * 2 GROUP BY ALL),
mask AS MATERIALIZED (SELECT sample_id, y::INT AS y, x::INT AS x, CASE WHEN value > 0 THEN y // 5 * 13 + x // 5 + 1 ELSE 0 END AS cell_id FROM s WHERE channel = 1){HULL[len(MASK):]}
SELECT sample_id, cell_id::INT AS cell_id, {r('avg(value) FILTER (channel = 1)')} AS "DAPI", {r('avg(value) FILTER (channel = 0)')} AS "CD3", count(*) FILTER (channel = 1)::DOUBLE AS "Area",
{r('avg(x) FILTER (channel = 1)')} AS "X_centroid", {r('avg(y) FILTER (channel = 1)')} AS "Y_centroid", {r('count(*) FILTER (channel = 1) / ((max(x) - min(x) + 1) * (max(y) - min(y) + 1))')} AS "Extent",
{r('count(*) FILTER (channel = 1) / any_value(area)')} AS "Solidity" FROM s JOIN mask USING (sample_id, y, x) JOIN hull USING (sample_id, cell_id) WHERE cell_id > 0 GROUP BY ALL""")
def wl1_sheets_to_cells(spark, d):
    """The image job: even images come as fields of 50 rows, odd ones whole, at 0.5 um a pixel; cells as in the mask view."""
    return _image_job(spark, d)["cells"].select("sample_id", "cell_id", "DAPI", "CD3", "Area", "X_centroid", "Y_centroid", "Extent", F.round("Solidity", 4).alias("Solidity"))


# Labels and lines of the image job: boundaries as in EDGES, on the scaled image.
JOB = f"""{PIXELS}, ends AS (SELECT sample_id, max(y) + 1 AS hh, max(x) + 1 AS ww FROM pixels GROUP BY ALL),
s AS MATERIALIZED (SELECT sample_id, y // 2 AS y, x // 2 AS x, avg(value) AS value FROM pixels JOIN ends USING (sample_id) WHERE y < hh // 2 * 2 AND x < ww // 2 * 2 GROUP BY ALL),
mask AS MATERIALIZED (SELECT sample_id, y::INT AS y, x::INT AS x, value, CASE WHEN value > 0 THEN y // 5 * 13 + x // 5 + 1 ELSE 0 END AS cell_id FROM s)""" + EDGES[len(MASK):]


@query(f"WITH {JOB} SELECT m.sample_id, m.y, m.x, {r('m.value')} AS value, m.cell_id::INT AS cell_id, e.value::DOUBLE AS line FROM mask m JOIN edges e USING (sample_id, y, x)")
def wl1_mask_and_overlay(spark, d):
    """The image job's mask and two-channel overlay, side by side."""
    made = _image_job(spark, d)
    shown = {c: pixels.to_pixels(made["bw_overlay"].where(F.col("channel") == c).drop("channel", "seg")) for c in (0, 1)}
    labels = pixels.to_pixels(made["mask"].drop("channel", "seg"), "cell_id")
    both = shown[0].join(labels, ["sample_id", "y", "x"]).join(shown[1].withColumnRenamed("value", "line"), ["sample_id", "y", "x"])
    return both.select("sample_id", "y", "x", "value", "cell_id", "line")


def _image_job(spark, d):
    stack = pixels.stack_channels(views.pixels(spark, d), views.pixels(spark, d, True))
    even = F.substring("sample_id", 4, 9).cast("int") % 2 == 0
    field = F.when(even, F.floor(F.col("y") / 50)).otherwise(0).cast("int")
    placed = stack.withColumn("path", F.concat(F.lit("f"), field.cast("string"))).withColumn("y", F.when(even, F.col("y") % 50).otherwise(F.col("y")))
    images = pixels.to_tiles(placed, 32, by=("sample_id", "path", "channel")).withColumn("level", F.lit(0))
    files = placed.select("sample_id", "path", F.when(even, "tiles").otherwise("stitched").alias("format")).distinct()
    regions = files.where("format = 'tiles'").select("sample_id", "path", F.lit(7).alias("x"), (F.substring("path", 2, 9).cast("int") * 50 + 5).alias("y"))
    ends = stack.groupBy("sample_id").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    levels = ends.select("sample_id", F.lit(0).alias("level"), F.lit("CYX").alias("axes"), F.array(F.lit(2), "h", "w").alias("shape"), F.lit(0.5).alias("physical_size_x"))
    named = ends.select("sample_id", F.explode(F.array(*[F.struct(F.lit(i).alias("channel"), F.lit(n).alias("name")) for i, n in enumerate(("cd3", "dapi"))])).alias("c")).select("sample_id", "c.*")
    sheet = spark.createDataFrame([("DAPI", None, "1", 0), ("CD3", None, "1", 1)], "marker_name string, channel_name string, cycle_number string, marker_idx int")

    return workloads.sheets_to_cells(files, images, levels, named, sheet, _squares, regions, block=32)


def _squares(nuclei: DataFrame, membrane: DataFrame | None) -> DataFrame:
    """Mask blocks: positive pixels of 5 x 5 squares, labelled as in the mask view."""

    def labelled(s):
        place = lambda i: F.floor((s["y0"] + F.floor(i / s["w"])) / 5) * 13 + F.floor((s["x0"] + i % s["w"]) / 5) + 1
        return F.transform(s["values"], lambda v, i: F.when(v > 0, place(i)).otherwise(0).cast("int"))

    return nuclei.withColumn("values", scalar.let(F.struct("values", "y0", "x0", "w"), labelled))


@query(f"WITH {EDGES} SELECT sample_id, y, x, value::DOUBLE AS value FROM edges")
def p14_boundary_tiles(spark, d):
    """Block form: a block travels with a rim of one pixel."""
    labels = pixels.to_tiles(views.mask(spark, d).withColumn("channel", F.lit(0)), 32, "cell_id")
    return pixels.to_pixels(halo.boundary_tiles(labels, 32)).select("sample_id", "y", "x", "value")


@query()
def x1_segment(spark, d):
    """A plain segmenter: connected bright runs of a row within a block."""
    return halo.segment(pixels.to_tiles(views.pixels(spark, d), 32), _bright_runs, 16, 32)


def _bright_runs(area):
    import numpy as np

    bright = area > 0.05
    first = bright & ~np.pad(bright, ((0, 0), (1, 0)))[:, :-1]
    return np.where(bright, np.cumsum(first.ravel()).reshape(area.shape), 0)


# -- clustering -------------------------------------------------------------------------------------------------------


def _flat(features: DataFrame) -> DataFrame:
    return features.select("sample_id", "cell_id", F.posexplode("v").alias("i", "value"))


@query(f"WITH {FEATURES}, t AS (SELECT *, exp(list_sum(list_transform(v, lambda x: CASE WHEN x > 0 THEN ln(1 + x) ELSE 0.0 END)) / len(v)) AS m FROM features) SELECT sample_id, cell_id, (i - 1)::INT AS i, {r('ln(1 + v[i] / m)')} AS value FROM t, range(1, 65) AS g(i)")
def c1_clr_normalise(spark, d):
    return _flat(cluster.clr_normalise(views.features(spark, d)))


@query(f"WITH {FEATURES}, l AS (SELECT sample_id, cell_id, (i - 1)::INT AS i, v[i] AS x FROM features, range(1, 65) AS g(i)) SELECT sample_id, cell_id, i, {r('least((x - avg(x) OVER w) / stddev_samp(x) OVER w, 10.0)')} AS value FROM l WINDOW w AS (PARTITION BY sample_id, i)")
def c2_scale_features(spark, d):
    return _flat(cluster.scale_features(views.features(spark, d)))


@query(f"WITH {FEATURES}, l AS MATERIALIZED (SELECT sample_id, cell_id, i, v[i] AS x FROM features, range(1, 65) AS g(i)) SELECT a.sample_id, (a.i - 1)::INT AS i, (b.i - 1)::INT AS j, count(*) AS n, {r('sum(a.x * b.x)')} AS product FROM l a JOIN l b USING (sample_id, cell_id) GROUP BY ALL")
def c3_gram(spark, d):
    """The sums of products that the axes come from: matrices added up in the tasks."""
    each = cluster.gram(views.features(spark, d)).select("sample_id", "n", F.posexplode("products").alias("at", "product"))
    return each.select("sample_id", F.floor(F.col("at") / 64).cast("int").alias("i"), (F.col("at") % 64).cast("int").alias("j"), "n", "product")


@query()
def c3_pca(spark, d):
    return cluster.pca(cluster.scale_features(views.features(spark, d)))


@query()
def t4_leverage_sample(spark, d):
    return cluster.sketch(views.features(spark, d)).select("sample_id", "cell_id")


KNN = FEATURES + """, pairs AS (SELECT a.sample_id, a.cell_id, b.cell_id AS neighbour_id, list_distance(a.v, b.v) AS dist FROM features a JOIN features b USING (sample_id)),
knn AS (SELECT *, row_number() OVER (PARTITION BY sample_id, cell_id ORDER BY dist, neighbour_id)::INT AS rank FROM pairs QUALIFY rank <= 20)"""


@query(f"WITH {KNN} SELECT sample_id, cell_id, neighbour_id, rank, {r('dist')} AS dist FROM knn")
def c4_knn(spark, d):
    return cluster.knn(views.features(spark, d), 20, vector="v")


@query(f"WITH {KNN}, s AS (SELECT a.sample_id, a.cell_id AS src, b.cell_id AS dst, count(*) AS s FROM knn a JOIN knn b USING (sample_id, neighbour_id) WHERE a.cell_id < b.cell_id GROUP BY ALL) SELECT sample_id, src, dst, {r('s / (40.0 - s)')} AS weight FROM s WHERE s / (40.0 - s) >= 1 / 15.0")
def c5_snn(spark, d):
    return cluster.snn(cluster.knn(views.features(spark, d), 20, vector="v"))


def _points(spark, d):
    return cluster.pca(cluster.scale_features(views.features(spark, d)))


@query()
def c6_louvain(spark, d):
    return cluster.clusters(cluster.snn(cluster.knn(_points(spark, d))))


@query()
def c7_transfer_labels(spark, d):
    points = _points(spark, d)
    sketch = points.join(cluster.sketch(views.features(spark, d)).select("sample_id", "cell_id"), ["sample_id", "cell_id"], "left_semi")
    return cluster.labels_of_all(sketch, views.labels(spark, d), points)


VOTE = FEATURES + """, near AS (SELECT a.sample_id, a.cell_id, b.cell_id AS other, list_distance(a.v, b.v) AS dist FROM features a JOIN features b ON a.sample_id = b.sample_id AND b.v[1] > 0),
first AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY sample_id, cell_id ORDER BY dist, other) <= 20),
weighted AS (SELECT *, CASE WHEN max(dist) OVER w > 0 THEN 1 - dist / max(dist) OVER w ELSE 1.0 END + 1e-9 AS weight FROM first WINDOW w AS (PARTITION BY sample_id, cell_id)),
votes AS (SELECT w.sample_id, w.cell_id, resolution, cluster, sum(weight) AS weight FROM weighted w JOIN labels l ON l.sample_id = w.sample_id AND l.cell_id = w.other GROUP BY ALL)"""


@query(f"WITH {LABELS}, {VOTE} SELECT sample_id, cell_id, resolution, cluster FROM votes QUALIFY row_number() OVER (PARTITION BY sample_id, cell_id, resolution ORDER BY weight DESC, cluster) = 1")
def c7_transfer_vote(spark, d):
    """All cells take the labels of a sketch, here the cells whose first feature is positive."""
    points = views.features(spark, d).withColumnRenamed("v", "pc")
    return cluster.transfer_labels(points.where(F.get("pc", F.lit(0)) > 0), views.labels(spark, d), points)


@query()
def t4_leverage_draw(spark, d):
    """A sketch of half the cells of a sample of 250, so that a draw takes place."""
    return cluster.sketch(views.features(spark, d), 200, 125).select("sample_id", "cell_id")


@query()
def c8_fuzzy_graph(spark, d):
    return cluster.fuzzy_graph(cluster.knn(_points(spark, d)))


# The bandwidth of each cell by 64 halvings, as the operator finds it.
FUZZY = KNN + """, near AS (SELECT sample_id, cell_id, neighbour_id, dist FROM knn WHERE neighbour_id <> cell_id),
rho AS (SELECT sample_id, cell_id, coalesce(min(dist) FILTER (dist > 0), 0.0) AS rho FROM near GROUP BY ALL),
over AS MATERIALIZED (SELECT sample_id, cell_id, any_value(rho) AS rho, list(greatest(dist - rho, 0.0)) AS d FROM near JOIN rho USING (sample_id, cell_id) GROUP BY ALL),
fold(sample_id, cell_id, rho, d, k, low, high, mid) AS (
  SELECT sample_id, cell_id, rho, d, 0, 0.0::DOUBLE, 'inf'::DOUBLE, 1.0::DOUBLE FROM over
  UNION ALL
  SELECT sample_id, cell_id, rho, d, k + 1, CASE WHEN much THEN low ELSE mid END, CASE WHEN much THEN mid ELSE high END,
    CASE WHEN much THEN (low + mid) / 2 WHEN high = 'inf'::DOUBLE THEN mid * 2 ELSE (mid + high) / 2 END
  FROM (SELECT *, list_sum(list_transform(d, lambda x: exp(-x / mid))) > log2(20) AS much FROM fold WHERE k < 64)
), w AS (SELECT n.sample_id, cell_id AS i, neighbour_id AS j, exp(-greatest(dist - rho, 0.0) / greatest(mid, 1e-12)) AS w FROM near n JOIN (SELECT sample_id, cell_id, rho, mid FROM fold WHERE k = 64) USING (sample_id, cell_id))"""


@query(f"WITH RECURSIVE {FUZZY} SELECT sample_id, least(i, j) AS src, greatest(i, j) AS dst, {r('sum(w) - CASE WHEN count(*) > 1 THEN product(w) ELSE 0.0 END')} AS weight FROM w GROUP BY ALL")
def c8_fuzzy_features(spark, d):
    """The fuzzy graph of the features themselves."""
    return cluster.fuzzy_graph(cluster.knn(views.features(spark, d), 20, vector="v"))


@query()
def c8b_layout_2d(spark, d):
    return cluster.layout_2d(cluster.fuzzy_graph(cluster.knn(_points(spark, d))))


CLUSTERED = FEATURES + ", " + LABELS + ", j AS (SELECT l.sample_id, resolution, cluster, 'm' || (i - 1) AS marker, v[i] AS value FROM features JOIN labels l USING (sample_id, cell_id), range(1, 65) AS g(i))"


def _marked(spark, d):
    return _flat(views.features(spark, d)).select("sample_id", "cell_id", F.concat(F.lit("m"), F.col("i").cast("string")).alias("marker"), "value")


@query(f"WITH {CLUSTERED}, a AS (SELECT sample_id, resolution, cluster, marker, avg(value) AS mean FROM j GROUP BY ALL) SELECT sample_id, resolution, cluster, marker, {r('mean')} AS mean, {r('(mean - avg(mean) OVER w) / stddev_samp(mean) OVER w')} AS z FROM a WINDOW w AS (PARTITION BY sample_id, resolution, cluster)")
def c9_cluster_marker_means(spark, d):
    return cluster.cluster_marker_means(_marked(spark, d), views.labels(spark, d))


BY = "sample_id, resolution, cluster, marker"


@query(f"""WITH {CLUSTERED}, limits AS (SELECT sample_id, resolution, min(value) AS axis_low, max(value) AS axis_high FROM j GROUP BY ALL),
s AS (SELECT {BY}, count(value) AS n, min(value) AS low, max(value) AS high, stddev_samp(value) AS sd, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM j GROUP BY ALL),
b AS MATERIALIZED (SELECT *, 0.9 * CASE WHEN least(sd, iqr / 1.34) > 0 THEN least(sd, iqr / 1.34) WHEN sd > 0 THEN sd WHEN abs(low) > 0 THEN abs(low) ELSE 1.0 END * pow(n, -0.2) AS bw, (high - low) / 511 AS step FROM s),
a AS (SELECT {BY}, CASE WHEN step > 0 THEN (value - low) / step ELSE 0.0 END AS spot FROM j JOIN b USING ({BY})),
l AS (SELECT *, least(floor(spot), 510) AS lo FROM a),
w AS MATERIALIZED (SELECT {BY}, bin, sum(w) AS w FROM (SELECT {BY}, lo AS bin, 1 - (spot - lo) AS w FROM l UNION ALL SELECT {BY}, lo + 1, spot - lo FROM l) GROUP BY ALL HAVING sum(w) > 0),
d AS (SELECT {BY}, k, any_value(low) + k * any_value(step) AS x, sum(w * exp(-0.5 * pow((k - bin) * step / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS density FROM w JOIN b USING ({BY}), range(0, 512) AS g(k) GROUP BY {BY}, k)
SELECT sample_id, resolution, cluster, marker, k::INT AS k, {r('x')} AS x, {r('density')} AS density, {r('axis_low')} AS axis_low, {r('axis_high')} AS axis_high FROM d JOIN limits USING (sample_id, resolution)""")
def c10_cluster_marker_density(spark, d):
    return cluster.cluster_marker_density(_marked(spark, d), views.labels(spark, d))


@query(f"WITH {CELLS} SELECT sample_id, cell_id, \"Y_centroid\" AS x, \"X_centroid\" AS y, (\"Area\" % 7)::INT AS cluster, {cluster.palette()[:7]}[(\"Area\" % 7)::INT + 1] AS colour FROM cells")
def c11_spatial_map(spark, d):
    cells = views.cells(spark, d)
    numbered = cells.withColumn("cell_id", F.struct("cell_id", "row_key"))
    labels = numbered.select("sample_id", "cell_id", (F.col("Area") % 7).cast("int").alias("cluster"))
    return cluster.spatial_map(numbered, labels).select("sample_id", F.col("cell_id.cell_id").alias("cell_id"), "x", "y", "cluster", "colour")


@query(f"WITH {CELLS}, l AS (" + " UNION ALL ".join(f"SELECT sample_id, cell_id, \"Y_centroid\" AS x, \"X_centroid\" AS y, '{m}' AS marker, \"{m}\" AS value FROM cells" for m in MARKERS) + f") SELECT sample_id, cell_id, x, y, marker, {r('value')} AS value FROM l")
def c12_spatial_marker_map(spark, d):
    return cluster.spatial_marker_map(views.cells(spark, d), MARKERS)


@query(f"WITH {FEATURES}, {LABELS} SELECT sample_id, resolution, cluster, {r('median(v[1])')} AS x, {r('median(v[2])')} AS y FROM features JOIN labels USING (sample_id, cell_id) GROUP BY ALL")
def c13_cluster_labels_2d(spark, d):
    layout = views.features(spark, d).select("sample_id", "cell_id", F.get("v", F.lit(0)).alias("x"), F.get("v", F.lit(1)).alias("y"))
    return cluster.cluster_labels_2d(layout, views.labels(spark, d))


# -- files: written from the tables, read by the operators ------------------------------------------------------------


def _csv(df: DataFrame) -> str:
    path = storage.shared_dir(df.sparkSession)
    df.write.option("header", True).csv(path)
    return path


@query(f"WITH {MANIFEST} SELECT sample_id, path, coalesce(format, 'tiles') AS format FROM manifest")
def s1_read_manifest(spark, d):
    sheet = views.manifest(spark, d).select(F.col("sample_id").alias("sample"), F.col("path").alias("tiffs"), "format")
    return manifest.read_manifest(spark, _csv(sheet))


@query("SELECT p_brand AS marker_name, min(p_type) AS channel_name, count(*)::VARCHAR AS cycle_number, (row_number() OVER (ORDER BY p_brand) - 1)::INT AS marker_idx FROM part GROUP BY p_brand")
def s2_read_markers(spark, d):
    """A sheet of the brands, in order, in one file."""
    sheet = views.table(spark, d, "part").groupBy(F.col("p_brand").alias("marker_name")).agg(F.min("p_type").alias("channel_name"), F.count("*").alias("cycle_number"))
    return manifest.read_markers(spark, _csv(sheet.orderBy("marker_name").coalesce(1)))


@query(f"""WITH {CELLS} SELECT 'run' AS sample_id, cell_id::VARCHAR AS cell_id, "DAPI", {r('"HLA.ABC"')} AS "HLA.ABC", "X_centroid" FROM cells WHERE "DAPI" <> 7 AND "Y_centroid" % 5 <> 0""")
def s5_read_cells(spark, d):
    """Cells as CSV, with infinite and missing values in it."""
    c = F.col
    raw = views.cells(spark, d).select(c("cell_id").alias("CellID"), F.when(c("DAPI") == 7, "inf").otherwise(c("DAPI").cast("string")).alias("DAPI"), c("`HLA.ABC`").alias("HLA-ABC"), F.when(c("Y_centroid") % 5 != 0, c("X_centroid")).alias("X centroid"))
    return cell_files.read_cells(spark, _csv(raw), "run").select("sample_id", "cell_id", "DAPI", "`HLA.ABC`", F.col("`X.centroid`").alias("X_centroid"))


@query(f"WITH {PIXELS} SELECT sample_id, y, x, {r('value')} AS value FROM pixels")
def s6_read_tiles(spark, d):
    """One of two channels of a block table laid out by sample and channel."""
    path = storage.shared_dir(spark)
    cell_files.write_partitioned(_blocks(spark, d)[0], path, ("sample_id", "channel"))
    return pixels.to_pixels(cell_files.read_tiles(spark, path, channels=[1])).select("sample_id", "y", "x", "value")


@query(f"""WITH {CELLS} SELECT sample_id, 'seg' || ("Area" % 2)::INT AS seg, cell_id, {r('"HLA.ABC"')} AS value FROM cells""")
def s7_write_partitioned(spark, d):
    path, seg = storage.shared_dir(spark), F.concat(F.lit("seg"), (F.col("Area") % 2).cast("int").cast("string"))
    cell_files.write_partitioned(views.cells(spark, d).select("sample_id", seg.alias("seg"), "cell_id", F.col("`HLA.ABC`").alias("value")), path)
    return spark.read.parquet(path).select("sample_id", "seg", "cell_id", "value")


@query("SELECT CASE p_partkey % 6 WHEN 4 THEN 'CD8' ELSE 'CD45' END AS marker_name, p_partkey::INT AS marker_idx FROM part WHERE p_partkey % 6 IN (4, 5)")
def v7_missing_markers(spark, d):
    """A long sheet of six names, of which the cell table has four."""
    names = F.array(*map(F.lit, [*MARKERS, "CD8", "CD45"]))
    sheet = views.table(spark, d, "part").select(F.get(names, (F.col("p_partkey") % 6).cast("int")).alias("marker_name"), F.col("p_partkey").cast("int").alias("marker_idx"))
    return report.missing_markers(sheet, views.cells(spark, d).columns)


@query(f"WITH {PIXELS} SELECT sample_id, y AS channel, 0 AS y, x, {r('value')} AS value FROM pixels")
def p12_normalise_axes(spark, d):
    """A plane without a channel, then with its first two axes swapped."""
    return pixels.permute_axes(pixels.normalise_axes(views.pixels(spark, d).drop("channel")), (1, 0, 2))
