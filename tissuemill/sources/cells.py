"""Cell tables, block tables, and where results go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuemill.functions.scalar import make_names


def clean_names(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Names as valid column names, in order."""
    if not names:
        return []
    row = spark.range(1).select(*[make_names(F.lit(n)).alias(f"c{i}") for i, n in enumerate(names)]).first()
    return list(row)


def read_cells(spark: SparkSession, path: str, sample_id: str | None = None, text: Sequence[str] = ("CellID",)) -> DataFrame:
    """A cell table from CSV: names made valid, ``""`` and ``inf`` missing, rows with anything missing left out.

    Columns but ``text`` are doubles; row_id keeps the order of the file's rows.
    """
    raw = spark.read.csv(path, header=True)
    names = clean_names(spark, raw.columns)
    raw = raw.toDF(*names)
    cast = {n: F.when(F.col(f"`{n}`").isin("", "inf"), None).otherwise(F.col(f"`{n}`")) for n in names}
    cells = raw.select(*[(c if n in text else c.cast("double")).alias(n) for n, c in cast.items()])
    for n, kind in cells.dtypes:
        cells = cells.where(F.col(f"`{n}`").isNotNull() & ~F.isnan(f"`{n}`") if kind == "double" else F.col(f"`{n}`").isNotNull())
    cells = cells.withColumn("row_id", F.monotonically_increasing_id())
    if sample_id is not None:
        cells = cells.withColumn("sample_id", F.lit(sample_id))
    return cells.withColumnRenamed("CellID", "cell_id")


def read_tiles(spark: SparkSession, path: str, samples: Sequence[str] | None = None, channels: Sequence[int] | None = None) -> DataFrame:
    """Image blocks; samples and channels are pruned by partition where the table is laid out by them."""
    tiles = spark.read.parquet(path)
    if samples is not None:
        tiles = tiles.where(F.col("sample_id").isin(list(samples)))
    return tiles if channels is None else tiles.where(F.col("channel").isin(list(channels)))


read_mask = read_tiles


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("sample_id", "seg"), files: int = 16, form: str = "parquet") -> None:
    """Publish a table below ``path``, a folder for each sample and segmentation.

    Rows of a folder are spread over up to ``files`` tasks by a hash of the row, so that a large sample isn't one task.
    """
    spread = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(files))
    df.repartition(*by, spread).write.partitionBy(*by).mode("errorifexists").format(form).option("header", True).save(path)
