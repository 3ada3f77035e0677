"""Centroid clustering in whole numbers, with distances screened by bounds from segment norms.

Every vector and every centroid is compressed once to two numbers a segment of its components: the norm of the segment's mean
part and the norm of what is left of it. By Cauchy and Schwarz, neither part of a segment's scalar product is larger than the
product of its norms, so the distance of two compressed vectors is never above that of the vectors. A centroid whose bound is above a
distance already known can't be the nearest; only the others get exact distances, in 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.storage import forget, materialise

#: Components of a segment.
WIDTH = 8
#: Vectors that are compared at once.
SLICE = 4096


def compressed(x: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Two numbers a segment: the mean part, with its sign, and the norm of the rest. A last segment may be shorter."""
    out = []
    for low in range(0, x.shape[1], width):
        part = x[:, low : low + width].astype(np.float64)
        mean = part.mean(axis=1)
        out += [mean * np.sqrt(part.shape[1]), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 0))


def nearest(x: np.ndarray, short: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each vector: its nearest centroid (the first of equals), the squared distance, and how many exact distances it took.

    x, centres: whole numbers; short: ``compressed(x)``. Bounds are lowered by far more than floating point can be off.
    """
    middle = compressed(centres)
    size = (short**2).sum(axis=1)[:, None] + (middle**2).sum(axis=1)
    bound = size - 2 * (short @ middle.T) - 1e-9 * size - 1
    who = bound.argmin(axis=1)
    best = ((x - centres[who]) ** 2).sum(axis=1)
    exact = np.ones(len(x), np.int64)
    for j in range(len(centres)):
        rows = np.flatnonzero((bound[:, j] <= best) & (who != j))
        d = ((x[rows] - centres[j]) ** 2).sum(axis=1)
        exact[rows] += 1
        won = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
        who[rows[won]], best[rows[won]] = j, d[won]
    return who, best, exact


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def whole_vectors(vectors: DataFrame, dim: int, scale: float) -> DataFrame:
    """A written table (vec_id, v, short) of the vectors with ``dim`` finite components: floor(scale * x), and their compressed form."""
    most = int((2**61 / dim) ** 0.5)
    real = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    fit = real.where((F.size("x") == dim) & F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))  # NaN is above infinity
    too_large = F.raise_error(F.lit(f"a component of over {most} has no distance in 64 bits"))
    whole = fit.select("vec_id", F.transform("x", lambda x: F.when(F.abs(x * scale) > most, too_large.cast("int")).otherwise(F.floor(x * scale).cast("int"))).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = compressed(_matrix(batch.column(1), np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(short) + 1, dtype=np.int32) * short.shape[1]), pa.array(short.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "v", "short"])

    return materialise(whole.mapInArrow(run, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, v array<int>, short array<double>"))


def starts(points: DataFrame, k: int, salt: int) -> np.ndarray:
    """The ``k`` vectors of the least sha256 of ``<salt>:<vec_id>``; ties (one vec_id) in the order of their components, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = points.select("v", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k vectors
    return np.array([r.v for r in rows], np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield part, _matrix(part.column("v"), np.int64), _matrix(part.column("short"), np.float64)


def moved(points: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors; one without vectors stays.

    A task returns a row a centroid; the driver gets k rows. Sums beyond 64 bits are an error of Spark's, not a wrong sum.
    """
    dim = centres.shape[1]
    names = [f"s{i}" for i in range(dim)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centres), dim), np.int64), np.zeros(len(centres), np.int64)
        for batch in batches:
            for _, x, short in _slices(batch):
                who = nearest(x, short, centres)[0]
                order = np.argsort(who, kind="stable")
                found, first, n = np.unique(who[order], return_index=True, return_counts=True)
                sums[found] += np.add.reduceat(x[order], first, axis=0)
                counts[found] += n
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held]), *(pa.array(sums[held, i]) for i in range(dim))], ["cluster", "n", *names])

    parts = points.mapInArrow(run, "cluster int, n long, " + ", ".join(f"{n} long" for n in names))
    out = centres.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]).collect():
        out[row.cluster] = [row[n] // row.n for n in names]
    return out


def assigned(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, n_exact) of every vector; n_exact: centroids that the bounds left for an exact distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x, short in _slices(batch):
                who, best, exact = nearest(x, short, centres)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(who.astype(np.int32)), pa.array(best), pa.array(exact)], ["vec_id", "cluster", "distance", "n_exact"])

    return points.mapInArrow(run, f"vec_id {points.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, n_exact long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256.0, salt: int = 2) -> DataFrame:
    """Of every kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, in whole numbers.

    Kept are vectors with exactly ``dim`` components, none null, NaN or infinite, as floor(scale * component). See ``starts`` for the
    first centroids (fewer, where there are fewer vectors) and ``moved`` for a round; after ``rounds`` of them vectors are assigned once more. distance: squared,
    to the nearest centroid (first of equals); inertia: distances added up over all, cluster_inertia: over the cluster;
    centroid_sha256: of the centroid's components, joined by commas.

    Rows that repeat a vec_id, or a vector, are vectors of their own; vec_ids may be null and of any type. An empty table gives no
    rows. Components whose squared distances can't be held in 64 bits are an error. Other columns are not read. Each round
    reads the written vectors anew and shuffles k rows a task; no vector is shuffled, so that a vector that a third of all rows
    hold is no burden to any task.
    """
    points = whole_vectors(vectors, dim, scale)
    centres = starts(points, k, salt)
    for _ in range(rounds if len(centres) else 0):
        centres = moved(points, centres)
    found = materialise(assigned(points, centres))
    forget(points)
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centres.tolist())]
    named = vectors.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(named, "cluster")
    per = per.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))  # k rows
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5) -> str:
    """The same clusters of ``embeddings`` in DuckDB, by all distances."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT row, min({{'d': (vv + cc - 2 * list_inner_product(v, c))::BIGINT, 'j': j}}) AS m
  FROM kept CROSS JOIN (SELECT j, c, list_inner_product(c, c) AS cc FROM c{i}) GROUP BY row
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.j, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT j, list(floor_of::DOUBLE ORDER BY place) AS c FROM (
      SELECT m.j AS j, place, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS floor_of
      FROM near{i} JOIN (SELECT row, unnest(v)::BIGINT AS x, generate_subscripts(v, 1) AS place FROM kept) USING (row) GROUP BY m.j, place
    ) GROUP BY j
  ) n USING (j)
)""")
    return f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, v, list_inner_product(v, v) AS vv, sha256('2:' || vec_id) AS h FROM whole
), c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS j, v AS c FROM kept QUALIFY j < {k}),
{", ".join(steps)},
last AS (SELECT vec_id, m.j AS j, m.d AS distance FROM near{rounds} JOIN kept USING (row))
SELECT vec_id, j::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM last JOIN c{rounds} USING (j)
"""
