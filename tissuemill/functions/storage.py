"""Cutting the lineage of long jobs with tables in shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Catalogue tables by their folder, and the folders written in each ``settled`` that runs.
_named: dict[str, str] = {}
_scopes: list[list[str]] = []


def _path(spark: SparkSession, name: str):
    """A Hadoop path, qualified by the default file system, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path), store


def shared_dir(spark: SparkSession) -> str:
    """A new folder name in shared storage, as a qualified URI.

    The folder is below the cluster's ``spark.checkpoint.dir``, or else below the folder given to ``setCheckpointDir``. Only a
    local master without either gets a temporary folder: on a cluster that would be each machine's own.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tissuemill-")
        base = _own[context.applicationId]
    return f"{_path(spark, base)[0].toString().rstrip('/')}/{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    path = shared_dir(spark)
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


def materialise(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` to shared storage and read it back: cuts the lineage, survives lost executors. ``options`` are the writer's."""
    path, schema = _folder(df.sparkSession), df.schema
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


class SampleRows:
    """Rows of a written table by sample, read in a task straight from shared storage, a row group at a time.

    ``by_sample`` writes such tables. Arrow opens the files, so shared storage must be one that it knows (a mounted folder, HDFS, S3, GCS).
    """

    def __init__(self, files: Sequence[str], columns: Sequence[str]):
        self.files, self.columns = files, list(columns)
        self.groups: list[tuple] = []

    def _open(self, uri: str, metadata=None):
        from pyarrow import fs, parquet

        store, path = fs.FileSystem.from_uri(uri)
        return parquet.ParquetFile(path, filesystem=store, metadata=metadata)

    def of(self, sample: str) -> Iterator[pa.Table]:
        if not self.groups:
            for uri in self.files:
                meta = self._open(uri).metadata
                at = meta.schema.names.index("sample_id")
                for i in range(meta.num_row_groups):
                    stats = meta.row_group(i).column(at).statistics
                    self.groups.append((uri, meta, i, *((stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None))))
        for uri, meta, i, low, high in self.groups:
            if low is None or low <= sample <= high:
                rows = self._open(uri, meta).read_row_group(i, columns=["sample_id", *self.columns], use_threads=False)
                if low is None or low < high:
                    rows = rows.filter(pc.equal(rows["sample_id"], sample))
                if len(rows):
                    yield rows.select(self.columns)


def by_sample(df: DataFrame, group_bytes: int = 1 << 20) -> DataFrame:
    """``materialise`` for ``SampleRows``: rows of a task in order of samples, in small row groups, of which a sample has few beside its own."""
    return materialise(df.sortWithinPartitions("sample_id"), **{"parquet.block.size": group_bytes, "compression": "zstd"})


def bucketed(df: DataFrame, by: str) -> DataFrame:
    """Like ``materialise``, in buckets of ``by``: joins on it shuffle the other side alone. ``forget`` drops the table."""
    spark, name = df.sparkSession, f"tissuemill_{uuid.uuid4().hex}"
    path, buckets = _folder(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, by).option("path", path).saveAsTable(name, format="parquet")
    _named[path] = name
    return spark.table(name)


@contextmanager
def lists_by_hash(spark: SparkSession, most: int) -> Iterator[None]:
    """What is written meanwhile collects up to ``most`` lists a task by hashing; Spark's default sorts from 128 on, before and after a shuffle."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _delete(spark: SparkSession, folder: str) -> None:
    if folder in _named:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop(folder)}")
    path, store = _path(spark, folder)
    store.delete(path, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` or ``bucketed`` has written, once nothing reads them any more."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            qualified = {_path(table.sparkSession, f)[0].toString(): f for f in _named}
            _delete(table.sparkSession, qualified.get(_path(table.sparkSession, folder)[0].toString(), folder))


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``make()``, written; the tables that ``make`` wrote on the way are deleted then. Calls may be nested."""
    _scopes.append([])
    try:
        found = make()
        path = shared_dir(spark)
        found.write.parquet(path)
    finally:
        for folder in _scopes.pop():
            _delete(spark, folder)
    for scope in _scopes[-1:]:
        scope.append(path)
    return spark.read.schema(found.schema).parquet(path)
