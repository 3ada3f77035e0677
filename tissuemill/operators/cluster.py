"""Normalisation, reduction, neighbours, clusters and maps of cells, for all samples at once.

``features`` is (sample_id, cell_id, v ARRAY<DOUBLE>): the marker columns without the nuclear one, in a fixed order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.functions.quantiles import quantiles
from tissuemill.functions.scalar import let
from tissuemill.functions.selection import first_rows
from tissuemill.functions.storage import SampleRows, by_sample, forget, materialise
from tissuemill.operators.report import density

CELL = ["sample_id", "cell_id"]
RESOLUTIONS = (0.25, 0.5, 0.75, 1.0)


def to_features(cells: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Marker columns as one array; missing values are 0."""
    values = [F.coalesce(F.col(f"`{m}`").cast("double"), F.lit(0.0)) for m in markers]
    return cells.select(*CELL, F.array(*values).alias("v"))


def clr_normalise(features: DataFrame) -> DataFrame:
    """log1p(x / exp(sum of log1p over the cell's positive values / number of markers)); row by row."""
    divided = lambda total: F.transform("v", lambda x: F.log1p(x / F.exp(total / F.size("v"))))
    return features.withColumn("v", F.aggregate("v", F.lit(0.0), lambda a, x: a + F.when(x > 0, F.log1p(x)).otherwise(0.0), divided))


def _moments(features: DataFrame) -> DataFrame:
    """(sample_id, means, sds): a row for each sample."""
    long = features.select("sample_id", F.posexplode("v").alias("i", "x"))
    each = long.groupBy("sample_id", "i").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    row = each.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("i", "m", "s"))).alias("a"))
    return row.select("sample_id", F.transform("a", lambda a: a["m"]).alias("means"), F.transform("a", lambda a: a["s"]).alias("sds"))


def scale_features(features: DataFrame, top: float = 10.0) -> DataFrame:
    """(x - mean) / sd of each marker in its sample, at most ``top``; 0 where the sd is 0 or unknown."""
    joined = features.join(_moments(features), "sample_id")
    pairs = F.arrays_zip("v", "means", "sds")
    scaled = F.transform(pairs, lambda p: F.when(p["sds"] > 0, F.least((p["v"] - p["means"]) / p["sds"], F.lit(top))).otherwise(0.0))
    return joined.select(*CELL, scaled.alias("v"))


def gram(features: DataFrame) -> DataFrame:
    """(sample_id, n, total, products): row count, sums and the d x d sums of products of each sample.

    Every task adds up its own rows; a task's matrices of a sample are what is shuffled, whatever the number of cells.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for sample, part in batch.groupby("sample_id"):
                x = np.stack(part.v.to_numpy())
                n, s, g = held.get(sample, (0, 0, 0))
                held[sample] = n + len(x), s + x.sum(axis=0), g + x.T @ x
        yield pd.DataFrame([(k, n, s, g.ravel()) for k, (n, s, g) in held.items()], columns=["sample_id", "n", "total", "products"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(part.sample_id.iloc[0], part.n.sum(), np.sum(np.stack(part.total), axis=0), np.sum(np.stack(part["products"]), axis=0))], columns=["sample_id", "n", "total", "products"])

    schema = "sample_id string, n long, total array<double>, products array<double>"
    return features.select("sample_id", "v").mapInPandas(run, schema).groupBy("sample_id").applyInPandas(add, schema)


def principal_axes(features: DataFrame, k: int = 6) -> DataFrame:
    """(sample_id, mean, axes ARRAY<ARRAY<DOUBLE>>): the first k axes, the largest loading of each positive."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        mean = row.total / row.n
        d = len(mean)
        cov = (row["products"].reshape(d, d) - row.n * np.outer(mean, mean)) / max(1, row.n - 1)
        _, vectors = np.linalg.eigh(cov)
        axes = vectors[:, ::-1][:, : min(k, d)].T
        axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
        return pd.DataFrame([(row.sample_id, mean, list(axes))], columns=["sample_id", "mean", "axes"])

    return gram(features).groupBy("sample_id").applyInPandas(run, "sample_id string, mean array<double>, axes array<array<double>>")


def project(features: DataFrame, axes: DataFrame) -> DataFrame:
    """Scores of cells on axes, which may come from a sketch of them."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    centred = F.zip_with("v", "mean", lambda x, m: x - m)
    scores = let(centred, lambda c: F.transform("axes", lambda a: dot(a, c)))
    return features.join(axes, "sample_id").select(*CELL, scores.alias("pc"))


def pca(features: DataFrame, k: int = 6) -> DataFrame:
    return project(features, principal_axes(features, k))


def _uniform(seed: int) -> Column:
    """A number in (0, 1) from the cell's ids."""
    return (F.shiftrightunsigned(F.xxhash64(*CELL, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def leverage_scores(features: DataFrame) -> DataFrame:
    """(sample_id, cell_id, leverage): x' (X'X)^-1 x of each cell in its sample (pseudo-inverse)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        d = len(row.total)
        return pd.DataFrame([(row.sample_id, list(np.linalg.pinv(row["products"].reshape(d, d))))], columns=["sample_id", "inverse"])

    inverse = gram(features).groupBy("sample_id").applyInPandas(run, "sample_id string, inverse array<array<double>>")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    out = features.join(inverse, "sample_id")
    return out.select(*CELL, dot(F.col("v"), F.transform("inverse", lambda r: dot(r, F.col("v")))).alias("leverage"))


def leverage_sample(features: DataFrame, n: int = 50_000, seed: int = 0) -> DataFrame:
    """``n`` cells of each sample that has more, drawn without replacement with probability as their leverage.

    Keys -ln(u)/w are exponential races: the n least are the draw. They are found by counts of keys in ranges of their logarithm,
    256 an octave and then 2^20 an octave: only the cells of one such range are ranked.
    """
    key = -F.log(_uniform(seed)) / F.greatest("leverage", F.lit(1e-12))
    raced = materialise(leverage_scores(features).select(*CELL, key.alias("_key")))
    fine = lambda parts: F.floor(F.log2("_key") * parts)
    chosen = first_rows(raced, ["sample_id"], n, [fine(256), fine(1 << 20)], [F.col("_key"), F.col("cell_id")])
    return features.join(chosen.select(*CELL), CELL, "left_semi")


def sketch(features: DataFrame, limit: int = 100_000, n: int = 50_000) -> DataFrame:
    """Samples of up to ``limit`` cells whole, and of each larger sample a leverage sample of ``n`` cells."""
    large = samples_over(features, limit)
    return features.join(large, "sample_id", "left_anti").unionByName(leverage_sample(features.join(large, "sample_id", "left_semi"), n))


def samples_over(cells: DataFrame, limit: int) -> DataFrame:
    return cells.groupBy("sample_id").count().where(F.col("count") > limit).select("sample_id")


# -- neighbours -------------------------------------------------------------------------------------------------------


def _top(x: np.ndarray, y: np.ndarray, k: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of the k rows of y nearest to each of x, equal ones by their order in y; exact distances."""
    m, out = min(k, len(y)), []
    sizes = (y * y).sum(axis=1)
    for at in range(0, len(x), rows):
        part = x[at : at + rows]
        own = (part * part).sum(axis=1)
        square = own[:, None] + sizes - 2 * part @ y.T  # off by rounding: all that may be among the k are measured anew
        far = np.partition(square, m - 1, axis=1)[:, m - 1] + 1e-9 * (own + sizes.max())
        i, j = np.nonzero(square <= far[:, None])
        dist = np.sqrt(((part[i] - y[j]) ** 2).sum(axis=1))
        order = np.lexsort((j, dist, i))
        i, j, dist = i[order], j[order], dist[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((i[place < m] + at, j[place < m], dist[place < m]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


NEAR = "sample_id string, cell_id {0}, neighbour_id {0}, dist double"


def _met(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    """The nearest data cells of query cells of one sample, as rows of ``NEAR``."""
    if queries.empty or data.empty:
        return pd.DataFrame(columns=["sample_id", "cell_id", "neighbour_id", "dist"])
    data = data.sort_values("cell_id")
    i, j, dist = _top(np.stack(queries.p), np.stack(data.p), k)
    return pd.DataFrame({"sample_id": queries.sample_id.iloc[0], "cell_id": queries.cell_id.to_numpy()[i], "neighbour_id": data.cell_id.to_numpy()[j], "dist": dist})


#: Pivots of a sample at most; beyond that its blocks are cut by hash.
PIVOTS = 64


def partitioned(data: DataFrame, block: int, vector: str = "pc") -> tuple[DataFrame, DataFrame]:
    """Data cells in blocks round pivots (sample_id, cell_id, p, j, sub), and the blocks of each sample; both written.

    A sample's pivots are the cells of its least hashes, one for every ``block`` cells, ``PIVOTS`` at most. A cell belongs to
    its nearest pivot, so that a block is a cell of the pivots' Voronoi diagram; where that has over 2 * ``block`` cells (very
    many alike) it is cut by hash into subs. Blocks: an array of j, p (the pivot), r (its farthest cell), subs.
    """
    counts = data.groupBy("sample_id").agg(F.count("*").alias("n"))
    wanted = F.least(F.ceil(F.col("n") / block), F.lit(PIVOTS)).cast("int")
    hashed = materialise(data.select(*CELL, F.col(vector).alias("p"), F.xxhash64("cell_id").alias("_h")))
    drawn = first_rows(hashed, ["sample_id"], PIVOTS, [F.shiftright("_h", 48), F.shiftright("_h", 32)], [F.col("_h"), F.col("cell_id")])
    pivots = drawn.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("_h", "cell_id", "p"))).alias("a")).join(counts, "sample_id")  # PIVOTS rows a sample
    pivots = materialise(pivots.select("sample_id", F.transform(F.slice("a", F.lit(1), wanted), lambda x: x["p"]).alias("pivots")))
    least = let(F.struct("p", "pivots"), lambda s: F.array_min(F.transform(s["pivots"], lambda c, i: F.struct(_far(s["p"], c).alias("d"), i.alias("j")))))
    placed = hashed.join(pivots, "sample_id").select(*CELL, "p", "_h", least.alias("_m")).select(*CELL, "p", "_h", F.col("_m.j").alias("j"), F.col("_m.d").alias("d"))
    sizes = placed.groupBy("sample_id", "j").agg(F.max("d").alias("r"), F.ceil(F.count("*") / (2 * block)).cast("int").alias("subs"))
    blocks = sizes.join(pivots, "sample_id").select("sample_id", F.struct("j", F.get("pivots", F.col("j")).alias("p"), "r", "subs").alias("b"))
    blocks = materialise(blocks.groupBy("sample_id").agg(F.array_sort(F.collect_list("b")).alias("blocks")))
    subs = let(F.struct("blocks", "j"), lambda s: F.get(F.filter(s["blocks"], lambda b: b["j"] == s["j"]), F.lit(0))["subs"])
    cells = placed.join(blocks, "sample_id").select(*CELL, "p", "j", F.pmod("_h", subs).cast("int").alias("sub"))
    return materialise(cells), blocks


def _far(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def nearest(queries: DataFrame, data: DataFrame, k: int, block: int = 2000, vector: str = "pc") -> DataFrame:
    """(sample_id, cell_id, neighbour_id, rank, dist): each query cell's k nearest data cells of its sample, exactly.

    Data lie in blocks round pivots (``partitioned``). A query cell first meets a block of its nearest pivot, which bounds the distance of its k-th
    neighbour. A block farther off than that is skipped: every cell of block j is at least d(q, p_j) - r_j away, and at least
    (d(q, p_j)^2 - d(q, p_i)^2) / 2 d(p_i, p_j) if p_i is the cell's nearest pivot. The cell is sent to the others only, and the best k
    of all are merged. Ties go to the smaller id. Vectors of more than ``FEW_PARTS`` are met in place (``_in_place``).
    """
    held = by_sample(data.select(*CELL, F.col(vector).alias("p")))
    asking = held if queries is data else queries.select(*CELL, F.col(vector).alias("p"))
    one = held.select(F.size("p")).first()
    if one and one[0] > FEW_PARTS:
        return _in_place(asking, held, k)
    cells, blocks = partitioned(held, block, "p")
    first, more = _sent(asking, blocks, cells, k, block, "p")
    return _merged(first.unionByName(more), k)


#: In vectors of more parts hardly a block is farther off than the k-th neighbour, and a query would be sent to nearly all.
FEW_PARTS = 12


class _Nearest:
    """The k nearest so far of rows x, equal ones by id, while rows of data come along; exact distances."""

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.k, self.own = x, k, (x * x).sum(axis=1)
        self.dist, self.ids = np.full((len(x), k), np.inf), None

    def meet(self, y: np.ndarray, ids: np.ndarray, rows: int = 256) -> None:
        if self.ids is None:
            self.ids = np.full(self.dist.shape, ids[0], ids.dtype)
        far = self.dist[:, -1]
        if np.isinf(far).any():
            order = np.argsort(ids, kind="stable")
            i, j, dist = _top(self.x, y[order], self.k)
            self._merge(i, ids[order][j], dist)
            return
        sizes, found = (y * y).sum(axis=1), []
        limit = far * far + 1e-9 * (self.own + sizes.max()) - self.own  # off by rounding: all that may be nearer are measured anew
        turned = -2 * y.T
        for at in range(0, len(self.x), rows):
            square = self.x[at : at + rows] @ turned
            square += sizes
            i, j = np.divmod(np.flatnonzero(square <= limit[at : at + rows, None]), len(y))
            i += at
            dist = np.sqrt(((self.x[i] - y[j]) ** 2).sum(axis=1))
            near = dist <= far[i]
            found.append((i[near], j[near], dist[near]))
        i, j, dist = (np.concatenate(c) for c in zip(*found, strict=True))
        if len(i):
            self._merge(i, ids[j], dist)

    def _merge(self, i: np.ndarray, ids: np.ndarray, dist: np.ndarray) -> None:
        changed = np.unique(i)
        i, ids, dist = np.concatenate([np.repeat(changed, self.k), i]), np.concatenate([self.ids[changed].ravel(), ids]), np.concatenate([self.dist[changed].ravel(), dist])
        order = np.lexsort((np.unique(ids, return_inverse=True)[1] if ids.dtype == object else ids, dist, i))
        i = i[order]
        order = order[np.arange(len(i)) - np.searchsorted(i, i) < self.k]
        self.ids[changed], self.dist[changed] = ids[order].reshape(-1, self.k), dist[order].reshape(-1, self.k)


def _matrix(lists: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Each sample's part of each batch."""
    for batch in batches:
        for sample in pc.unique(batch["sample_id"]).drop_null().to_pylist():
            yield sample, batch.filter(pc.equal(batch["sample_id"], sample))


def _in_place(queries: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """``nearest`` where queries stay: a task takes its batches over all cells of the sample, which it reads row group by row group.

    Nothing is shuffled or written but the cells (``held``, by ``by_sample``), and a task holds a batch and a row group. The work is quadratic in the sample.
    """
    files, kind = held.inputFiles(), dict(queries.dtypes)["cell_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = SampleRows(files, ["cell_id", "p"])
        for sample, part in _samples(batches):
            near = _Nearest(_matrix(part["p"]), k)
            for rows in cells.of(sample):
                near.meet(_matrix(rows["p"]), rows["cell_id"].to_numpy())
            i, rank = np.nonzero(np.isfinite(near.dist))
            if len(i):
                own = part["cell_id"]
                columns = [pa.repeat(sample, len(i)), own.take(pa.array(i)), pa.array(near.ids[i, rank], own.type), pa.array((rank + 1).astype(np.int32)), pa.array(near.dist[i, rank])]
                yield pa.RecordBatch.from_arrays(columns, ["sample_id", "cell_id", "neighbour_id", "rank", "dist"])

    return queries.mapInArrow(run, f"sample_id string, cell_id {kind}, neighbour_id {kind}, rank int, dist double")


def _merged(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*CELL).orderBy("dist", "neighbour_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select(*CELL, "neighbour_id", "rank", "dist")


def _sent(queries: DataFrame, blocks: DataFrame, cells: DataFrame, k: int, block: int, vector: str) -> tuple[DataFrame, DataFrame]:
    """Neighbours from each query's first block (written), and from the further blocks that may hold nearer ones."""
    kind = dict(queries.dtypes)["cell_id"]
    ball = lambda s: F.transform(s["blocks"], lambda b: F.struct(_far(s["p"], b["p"]).alias("d"), b["j"].alias("j"), b["p"].alias("p"), b["r"].alias("r"), b["subs"].alias("subs")))
    seen = queries.select(*CELL, F.col(vector).alias("p")).join(blocks, "sample_id").withColumn("balls", let(F.struct("p", "blocks"), ball))
    seen = seen.withColumn("own", F.array_min("balls")).withColumn("sub", F.pmod(F.xxhash64("cell_id"), F.col("own.subs")).cast("int"))
    start = seen.select(*CELL, "p", F.col("own.j").alias("j"), "sub")
    first = materialise(_together(start, cells, k, block, kind))
    reach = first.groupBy(*CELL).agg(F.when(F.count("*") >= k, F.max("dist")).otherwise(float("inf")).alias("u"))

    def met(s: Column) -> Column:
        """The (j, sub) of blocks that a query must still meet."""
        slack = lambda low: low - 1e-9 * (F.abs(low) + s["own"]["d"] + 1e-300)

        def needed(b: Column) -> Column:
            apart = _far(s["own"]["p"], b["p"])
            plane = F.when(apart > 0, (b["d"] - s["own"]["d"]) * (b["d"] + s["own"]["d"]) / (2 * apart)).otherwise(0.0)
            return slack(F.greatest(b["d"] - b["r"], plane)) <= s["u"]

        places = F.flatten(F.transform(F.filter(s["balls"], needed), lambda b: F.transform(F.sequence(F.lit(0), b["subs"] - 1), lambda x: F.struct(b["j"].alias("j"), x.alias("sub")))))
        return F.filter(places, lambda t: (t["j"] != s["own"]["j"]) | (t["sub"] != s["sub"]))

    further = seen.join(reach, CELL).select(*CELL, "p", F.explode(let(F.struct("balls", "own", "sub", "u"), met)).alias("t")).select(*CELL, "p", "t.j", "t.sub")
    return first, _together(further, cells, k, block, kind)


def _together(queries: DataFrame, cells: DataFrame, k: int, block: int, kind: str) -> DataFrame:
    """Queries with the data block that they name; a block asked by very many is copied for every 4 * ``block`` of them."""
    place = ["sample_id", "j", "sub"]
    asked = queries.groupBy(*place).agg(F.ceil(F.count("*") / (4 * block)).cast("int").alias("copies"))
    asked = materialise(asked)
    q = queries.join(asked, place).withColumn("copy", F.pmod(F.xxhash64("cell_id", F.lit(1)), F.col("copies")).cast("int")).drop("copies")
    d = cells.join(asked, place).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    named = d.select(*[F.col(c).alias(f"_{c}") for c in (*place, "copy")], "cell_id", "p")
    return q.groupBy(*place, "copy").cogroup(named.groupBy(*[f"_{c}" for c in (*place, "copy")])).applyInPandas(lambda a, b: _met(a, b, k), NEAR.format(kind))


#: Bytes of data cells that may be broadcast to be met where the queries are.
MOST_BROADCAST = 128 << 20


def nearest_broadcast(queries: DataFrame, data: DataFrame, k: int, most: int = MOST_BROADCAST, vector: str = "pc") -> DataFrame:
    """``nearest`` without moving the queries: data of up to ``most`` bytes go to every task, and each batch of queries meets its
    sample's. Larger data are met by blocks. Meant for many queries and a bounded sketch."""
    bound = data.agg(F.coalesce(F.sum(8 * F.size(vector) + 64), F.lit(0))).first()[0]
    if bound > most:
        return nearest(queries, data, k, vector=vector)
    rows = data.select(*CELL, F.col(vector).alias("p")).toPandas()
    held = data.sparkSession.sparkContext.broadcast({s: part for s, part in rows.groupby("sample_id")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for sample, part in batch.groupby("sample_id"):
                if sample in held.value:
                    found = _met(part, held.value[sample], k)
                    found["rank"] = (found.groupby("cell_id", sort=False).cumcount() + 1).astype("int32")
                    yield found

    kind = dict(queries.dtypes)["cell_id"]
    return queries.select(*CELL, F.col(vector).alias("p")).mapInPandas(run, NEAR.format(kind) + ", rank int").select(*CELL, "neighbour_id", "rank", "dist")


def knn(points: DataFrame, k: int = 20, block: int = 2000, vector: str = "pc") -> DataFrame:
    """Each cell's k nearest cells, itself among them."""
    return nearest(points, points, k, block, vector)


def snn(neighbours: DataFrame, k: int = 20, prune: float = 1 / 15) -> DataFrame:
    """(sample_id, src, dst, weight), src < dst: shared neighbours s as s / (2k - s), from ``prune`` on.

    A pair must share at least m neighbours, so it shares one of the first k-m+1 of both, rarest first: only those are
    looked up, and the cells that are neighbours of very many drop out of them. The count is verified on whole sets. Pairs
    are made where they are counted: a task takes a batch of sets over all sets of the sample, read from shared storage a row group at a time.
    """
    m = max(1, int(np.ceil(2 * k * prune / (1 + prune) - 1e-9)))
    kind = dict(neighbours.dtypes)["neighbour_id"]
    lists = materialise(neighbours.groupBy(*CELL).agg(F.collect_list("neighbour_id").alias("set")))
    popular = by_sample(lists.select("sample_id", F.explode("set").alias("id")).groupBy("sample_id", "id").agg(F.count("*").alias("c")))
    common = popular.inputFiles()

    def rarest_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = SampleRows(common, ["id", "c"])
        for sample, part in _samples(batches):
            row, key = _flat(part["set"])
            names, code = np.unique(key, return_inverse=True)
            c = np.zeros(len(names), np.int64)
            for rows in counted.of(sample):
                at = _places(names, rows["id"].to_numpy())
                c[at[at >= 0]] = rows["c"].to_numpy()[at >= 0]
            order = np.lexsort((code, c[code], row))
            sets = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)), pa.array(key[order], part["set"].type.value_type))
            yield pa.RecordBatch.from_arrays([part["sample_id"], part["cell_id"], sets], ["sample_id", "cell_id", "set"])

    sets = by_sample(lists.select(*CELL, "set").mapInArrow(rarest_first, lists.select(*CELL, "set").schema))
    forget(lists, popular)
    files, cell = sets.inputFiles(), dict(sets.dtypes)["cell_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = SampleRows(files, ["cell_id", "set"])
        for sample, part in _samples(batches):
            ids, held = part["cell_id"].to_numpy(zero_copy_only=False), _Sets(*_flat(part["set"]), len(part), k - m + 1)
            for rows in others.of(sample):
                theirs = rows["cell_id"].to_numpy()
                for i, j, s in held.shared(*_flat(rows["set"]), lambda i, j, theirs=theirs: ids[i] < theirs[j]):
                    weight = s / (2 * k - s)
                    on = (weight >= prune) & (s > 0)
                    if on.any():
                        columns = [pa.repeat(sample, on.sum()), part["cell_id"].take(pa.array(i[on])), pa.array(theirs[j[on]], part["cell_id"].type), pa.array(weight[on])]
                        yield pa.RecordBatch.from_arrays(columns, ["sample_id", "src", "dst", "weight"])

    return sets.mapInArrow(run, f"sample_id string, src {cell}, dst {cell}, weight double")


def _flat(lists: pa.ListArray | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The row and the value of each element of lists."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False)


def _places(names: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where keys are in sorted names, -1 for others."""
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return np.where(names[at] == keys, at, -1)


class _Sets:
    """Sets (row and key of each element, in the sets' own order), found by their first ``front`` keys."""

    def __init__(self, row: np.ndarray, key: np.ndarray, n: int, front: int):
        self.front, self.names = front, np.unique(key)
        code = _places(self.names, key)
        self.codes, first = self._laid(row, code, n, -2)
        order = np.argsort(code[first], kind="stable")
        self.rows, self.starts = row[first][order], np.searchsorted(code[first][order], np.arange(len(self.names) + 1))

    def _laid(self, row: np.ndarray, code: np.ndarray, n: int, none: int) -> tuple[np.ndarray, np.ndarray]:
        """A column of codes for each set, and which elements are in front."""
        place = np.arange(len(row)) - np.searchsorted(row, row)
        out = np.full((place.max(initial=0) + 1, n), none, np.int32)
        out[place, row] = code
        return out, place < self.front

    def shared(self, row: np.ndarray, key: np.ndarray, wanted: Callable, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, number of common keys) of own sets i and others j that are ``wanted`` and have a common key in front."""
        n = row[-1] + 1 if len(row) else 0
        code = _places(self.names, key)
        theirs, first = self._laid(row, code, n, -1)
        first &= code >= 0
        j, code = row[first], code[first]
        hits = self.starts[code + 1] - self.starts[code]
        ends = np.cumsum(np.bincount(j, hits, n)).astype(np.int64)
        low = 0
        while low < n:  # up to ``most`` pairs, or one set's
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, "right")))
            at = slice(*np.searchsorted(j, [low, high]))
            number, begin = hits[at], self.starts[code[at]]
            a = self.rows[np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(number.sum())]
            b = np.repeat(j[at], number)
            on = wanted(a, b)
            pair = np.unique(a[on] * n + b[on])
            a, b = np.divmod(pair, n)
            mine, other = self.codes[:, a], theirs[:, b]
            yield a, b, sum(((mine == x).any(axis=0).astype(np.int64) for x in other), np.zeros(len(a), np.int64))
            low = high


def _weighted(near: DataFrame) -> DataFrame:
    """Neighbours with w: 1 - dist / (distance of the cell's k-th), all equal if that is 0."""
    far = F.max("dist").over(Window.partitionBy(*CELL))
    return near.withColumn("w", F.when(far > 0, 1 - F.col("dist") / far).otherwise(1.0) + 1e-9)


def transfer_labels(sketch: DataFrame, labels: DataFrame, full: DataFrame, k: int = 20) -> DataFrame:
    """(sample_id, cell_id, resolution, cluster): labels of all cells from their nearest sketch cells, by weighted vote.

    ``sketch`` and ``full`` have pc; a neighbour's weight is 1 - dist / (distance of the k-th), all equal if that is 0.
    """
    votes = _weighted(nearest_broadcast(full, sketch, k)).join(labels.select("sample_id", F.col("cell_id").alias("neighbour_id"), "resolution", "cluster"), ["sample_id", "neighbour_id"])
    votes = votes.groupBy(*CELL, "resolution", "cluster").agg(F.sum("w").alias("w"))
    return votes.groupBy(*CELL, "resolution").agg(F.max_by("cluster", F.struct("w", -F.col("cluster"))).alias("cluster"))


def labels_of_all(sketch: DataFrame, labels: DataFrame, full: DataFrame, k: int = 20, limit: int = 100_000) -> DataFrame:
    """Labels of all cells: samples of up to ``limit`` cells keep their own, those of larger samples come from the sketch."""
    large = samples_over(full, limit)
    moved = transfer_labels(*[df.join(large, "sample_id", "left_semi") for df in (sketch, labels, full)], k)
    return labels.join(large, "sample_id", "left_anti").select(moved.columns).unionByName(moved)


def transfer_layout(sketch: DataFrame, layout: DataFrame, full: DataFrame, k: int = 20) -> DataFrame:
    """(sample_id, cell_id, x, y): positions of all cells. Cells of the layout keep theirs; the others lie at the mean of
    their nearest sketch cells, weighted as in ``transfer_labels``."""
    placed = sketch.join(layout.select(*CELL), CELL, "left_semi")
    near = _weighted(nearest_broadcast(full.join(layout.select(*CELL), CELL, "left_anti"), placed, k))
    at = near.join(layout.select("sample_id", F.col("cell_id").alias("neighbour_id"), "x", "y"), ["sample_id", "neighbour_id"])
    mean = lambda name: (F.sum(F.col("w") * F.col(name)) / F.sum("w")).alias(name)
    return layout.select(*CELL, "x", "y").unionByName(at.groupBy(*CELL).agg(mean("x"), mean("y")))


def layout_of_all(sketch: DataFrame, layout: DataFrame, full: DataFrame, k: int = 20, limit: int = 100_000) -> DataFrame:
    """Positions of all cells: those of samples of up to ``limit`` cells as they are, larger samples' from their sketch."""
    large = samples_over(full, limit)
    moved = transfer_layout(*[df.join(large, "sample_id", "left_semi") for df in (sketch, layout, full)], k)
    return layout.join(large, "sample_id", "left_anti").select(moved.columns).unionByName(moved)


# -- graph clusters ---------------------------------------------------------------------------------------------------


#: Rows of a graph (both directions) that one task may hold: the sweeps of a sample up to that size run there.
MOST_ROWS = 1 << 22


def _int_hash(number: int, seeds: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int on top of other hashes."""
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    with np.errstate(over="ignore"):
        x = (seeds + p5 + np.uint64(4)) ^ (np.uint64(number) * p1)
        x = turn(x, 23) * p2 + p3
        x = (x ^ (x >> np.uint64(33))) * p2
        x = (x ^ (x >> np.uint64(29))) * p3
    return x ^ (x >> np.uint64(32))


def _sum_by(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of w by pairs of numbers below n, in order of a and b."""
    key = a.astype(np.int64) * n + b
    order = np.argsort(key, kind="stable")
    key, w = key[order], w[order]
    del order
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[first]
    return key // n, key % n, np.add.reduceat(w, first) if len(first) else w


def _settle(a: np.ndarray, b: np.ndarray, w: np.ndarray, seeds: np.ndarray, resolution: float, sweeps: int, levels: Sequence[int]) -> np.ndarray | str:
    """The community of each node of one graph, by the sweeps and levels of ``louvain``; a bound that was reached.

    Rows are both directions of each edge. Nodes are numbers in the order of their names; a community has the number of one of its nodes.
    """
    n = len(seeds)
    of = np.arange(n)
    for level in levels:
        nodes = np.flatnonzero(np.bincount(a, minlength=n))
        d, m2 = np.bincount(a, w, n), w.sum()
        apart = a != b
        ea, eb, ew = a[apart], b[apart], w[apart]

        def quality(c: np.ndarray) -> float:
            mass = np.bincount(c[nodes], d[nodes], n)
            return w[c[a] == c[b]].sum() / m2 - resolution * (mass * mass).sum() / m2 / m2

        c = np.arange(n)
        best, top, quiet = c, quality(c), 0
        for sweep in range(sweeps):
            mass = np.bincount(c[nodes], d[nodes], n)
            i, to, near = _sum_by(np.concatenate([ea, nodes]), np.concatenate([c[eb], c[nodes]]), np.concatenate([ew, np.zeros(len(nodes))]), n)
            stays = to == c[i]
            gain = np.round(near - resolution * d[i] * (mass[to] - np.where(stays, d[i], 0.0)) / m2, 9)
            order = np.lexsort((to, stays, gain, i))
            last = order[np.flatnonzero(np.diff(i[order], append=n))]
            new = c.copy()
            new[i[last]] = to[last]
            wish = int((new != c).sum())
            awake = _int_hash(sweep + 100 * level, seeds) % np.uint64(2) == 0
            c = np.where(awake, new, c)
            q = quality(c)
            quiet = 0 if q > top + 1e-7 else quiet + 1
            if q > top:
                best, top = c, q
            if not (wish > 0 and quiet < 4):
                break
        else:
            return f"louvain did not settle in {sweeps} sweeps"
        if len(np.unique(best[nodes])) == len(nodes):
            return of
        of = best[of]
        a, b, w = _sum_by(best[a], best[b], w, n)
    return "louvain did not settle in its levels"


def _settled_in_tasks(graph: DataFrame, resolution: float, sweeps: int, levels: Sequence[int]) -> DataFrame:
    """(sample_id, _n, _c): the communities of the nodes of each sample's graph, written. A sample is one task's."""

    def run(part: pa.Table) -> pa.Table:
        import xxhash

        ends = [part[x].combine_chunks() for x in ("a", "b")]
        w, sample = part["weight"].to_numpy(), part["sample_id"][0].as_py()
        del part
        names = pa.concat_arrays([e.unique() for e in ends]).unique()
        names = names.take(pc.sort_indices(names))
        a, b = (pc.index_in(e, names).to_numpy() for e in ends)
        del ends
        seeds = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in names.to_pylist()], np.uint64)
        apart = a != b
        a, b, w = np.concatenate([a, b[apart]]), np.concatenate([b, a[apart]]), np.concatenate([w, w[apart]])
        found = _settle(a, b, w, seeds, resolution, sweeps, levels)
        if isinstance(found, str):
            return pa.table([[sample], [None], [None], [found]], schema)
        return pa.table([pa.repeat(sample, len(names)).cast("string"), names, names.take(pa.array(found)), pa.nulls(len(names), "string")], schema)

    schema = pa.schema([(x, "string") for x in ("sample_id", "_n", "_c", "error")])
    made = materialise(graph.where("a <= b").groupBy("sample_id").applyInArrow(run, "sample_id string, _n string, _c string, error string"))
    error = made.agg(F.max("error")).first()[0]
    if error:
        raise RuntimeError(error)
    return made.drop("error")


def louvain(edges: DataFrame, resolution: float = 1.0, cells: DataFrame | None = None, sweeps: int = 200, levels: int = 50) -> DataFrame:
    """(sample_id, cell_id, cluster): modularity clusters of a weighted graph (src < dst), 0 being the largest.

    In a sweep every node weighs the communities of its neighbours by modularity gain; a half of the nodes, chosen by a
    hash, move at once. After the sweeps communities become nodes. Each sample ends its sweeps when no node would move or its
    modularity has not risen for four sweeps, its own best partition counts, and it is done when no nodes merge. At the
    bounds of sweeps and levels this is an error. Samples whose graph has up to ``MOST_ROWS`` rows, from the start or after
    some levels, are finished each in a task, by the same sweeps. Of larger ones, labels, the best so far and what each sample has reached are tables in shared
    storage, of which a sweep leaves one each; the driver learns how many samples go on, and nothing else.
    """
    both = edges.select("sample_id", F.col("src").alias("a"), F.col("dst").alias("b"), "weight").union(edges.select("sample_id", "dst", "src", "weight"))
    kind = dict(both.dtypes)["a"]
    of, parts = None, []
    graph = both.select("sample_id", F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "weight")
    for level in range(levels):
        rows = materialise(graph.groupBy("sample_id").agg(F.count("*").alias("rows")))
        few = rows.where(F.col("rows") <= MOST_ROWS).select("sample_id")
        n_few, n_many = rows.agg(F.count_if(F.col("rows") <= MOST_ROWS), F.count_if(F.col("rows") > MOST_ROWS)).first()
        if n_few:
            ends = _settled_in_tasks(graph.join(few, "sample_id", "left_semi"), resolution, sweeps, range(level, levels))
            if of is None:
                parts.append(ends.select("sample_id", F.col("_n").cast(kind).alias("cell_id"), F.col("_c").alias("node")))
            else:
                at = ends.withColumnRenamed("_n", "node")
                parts.append(of.join(at, ["sample_id", "node"]).select("sample_id", "cell_id", F.col("_c").alias("node")))
                of = of.join(few, "sample_id", "left_anti")
        if not n_many:
            break
        graph = graph.join(few, "sample_id", "left_anti")
        if of is None:
            graph = materialise(graph)
            of = graph.select("sample_id", F.col("a").cast(kind).alias("cell_id"), F.col("a").alias("node")).distinct()
        of = materialise(of)
        degree = graph.groupBy("sample_id", "a").agg(F.sum("weight").alias("d"))
        total = graph.groupBy("sample_id").agg(F.sum("weight").alias("m2"))
        label = materialise(degree.select("sample_id", F.col("a").alias("node"), F.col("a").alias("c"), "d"))

        def quality(label: DataFrame) -> DataFrame:
            """(sample_id, q, wish): of each sample, its modularity and the number of nodes that would move."""
            at = label.select("sample_id", "node", "c")
            own = graph.join(at.withColumnsRenamed({"node": "a", "c": "ca"}), ["sample_id", "a"]).join(at.withColumnsRenamed({"node": "b", "c": "cb"}), ["sample_id", "b"])
            inside = own.where("ca = cb").groupBy("sample_id").agg(F.sum("weight").alias("w"))
            mass = label.groupBy("sample_id", "c").agg(F.sum("d").alias("s"), F.sum("wish").alias("wish")).groupBy("sample_id").agg(F.sum(F.col("s") * F.col("s")).alias("s2"), F.sum("wish").alias("wish"))
            q = F.coalesce("w", F.lit(0.0)) / F.col("m2") - resolution * F.col("s2") / F.col("m2") / F.col("m2")
            return total.join(mass, "sample_id").join(inside, "sample_id", "left").select("sample_id", q.alias("q"), "wish")

        best = materialise(label.select("sample_id", "node", "c"))
        state = materialise(quality(label.withColumn("wish", F.lit(1))).select("sample_id", F.col("q").alias("top"), F.lit(0).alias("quiet")))  # of samples that go on
        for sweep in range(sweeps):
            if not state.count():
                break
            now = label.join(state.select("sample_id"), "sample_id", "left_semi")
            mass = now.groupBy("sample_id", "c").agg(F.sum("d").alias("mass"))
            near = graph.where("a <> b").join(now.select("sample_id", F.col("node").alias("b"), "c"), ["sample_id", "b"]).groupBy("sample_id", F.col("a").alias("node"), "c").agg(F.sum("weight").alias("w"))
            stay = now.select("sample_id", "node", "c", F.lit(0.0).alias("w"))
            choice = near.union(stay).groupBy("sample_id", "node", "c").agg(F.sum("w").alias("w"))
            choice = choice.join(now.select("sample_id", "node", F.col("c").alias("old"), "d"), ["sample_id", "node"]).join(mass, ["sample_id", "c"]).join(total, "sample_id")
            others = F.col("mass") - F.when(F.col("c") == F.col("old"), F.col("d")).otherwise(0.0)
            gain = F.round(F.col("w") - resolution * F.col("d") * others / F.col("m2"), 9)
            move = choice.groupBy("sample_id", "node").agg(F.max_by("c", F.struct(gain, (F.col("c") == F.col("old")).cast("int"), F.col("c"))).alias("new"), F.first("old").alias("old"), F.first("d").alias("d"))
            awake = F.pmod(F.xxhash64("node", F.lit(sweep + 100 * level)), F.lit(2)) == 0
            wish = (F.col("new") != F.col("old")).cast("int").alias("wish")
            moved = materialise(move.select("sample_id", "node", F.when(awake, F.col("new")).otherwise(F.col("old")).alias("c"), "d", wish))
            rose = F.col("q") > F.col("top")
            quiet = F.when(F.col("q") > F.col("top") + 1e-7, 0).otherwise(F.col("quiet") + 1)
            judged = materialise(state.join(quality(moved), "sample_id").select("sample_id", rose.alias("rose"), F.greatest("top", "q").alias("top"), quiet.alias("quiet"), "wish"))
            risen = judged.where("rose").select("sample_id")
            kept = materialise(best.join(risen, "sample_id", "left_anti").unionByName(moved.join(risen, "sample_id", "left_semi").select("sample_id", "node", "c")))
            after = materialise(judged.where("wish > 0 and quiet < 4").select("sample_id", "top", "quiet"))
            forget(label, best, state, judged)
            label, best, state = moved, kept, after
        else:
            if state.count():
                raise RuntimeError(f"louvain did not settle in {sweeps} sweeps")
        merged = materialise(best.select("sample_id", F.col("node").alias("_n"), F.col("c").alias("_c")))
        counts = merged.groupBy("sample_id").agg(F.count("*").alias("n"), F.countDistinct("_c").alias("m"))
        going = materialise(counts.where("m < n").select("sample_id"))
        if not going.count():
            break
        of = materialise(of.join(merged, (of["sample_id"] == merged["sample_id"]) & (of["node"] == merged["_n"]), "left").select(of["sample_id"], "cell_id", F.coalesce("_c", "node").alias("node")))
        ma, mb = merged.withColumnsRenamed({"_n": "a", "_c": "na"}), merged.withColumnsRenamed({"_n": "b", "_c": "nb"})
        graph = materialise(graph.join(going, "sample_id", "left_semi").join(ma, ["sample_id", "a"]).join(mb, ["sample_id", "b"]).groupBy("sample_id", F.col("na").alias("a"), F.col("nb").alias("b")).agg(F.sum("weight").alias("weight")))
    else:
        raise RuntimeError(f"louvain did not settle in {levels} levels")
    for part in parts:
        of = part if of is None else of.unionByName(part)
    if of is None:  # no edges
        of = both.select("sample_id", F.col("a").alias("cell_id"), F.col("a").cast("string").alias("node"))
    if cells is not None:  # cells without an edge are clusters of their own
        of = cells.select(*CELL).join(of, CELL, "left").select(*CELL, F.coalesce("node", F.concat(F.lit("alone "), F.col("cell_id").cast("string"))).alias("node"))
    sizes = of.groupBy("sample_id", "node").agg(F.count("*").alias("n"), F.min("cell_id").alias("least"))
    nth = F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("n"), "least")) - 1
    return of.join(sizes.withColumn("cluster", nth).select("sample_id", "node", "cluster"), ["sample_id", "node"]).select(*CELL, "cluster")


def clusters(edges: DataFrame, resolutions: Sequence[float] = RESOLUTIONS, cells: DataFrame | None = None) -> DataFrame:
    """(sample_id, cell_id, resolution, cluster) at several resolutions, from the same edges."""
    edges = materialise(edges)
    one = lambda r: louvain(edges, r, cells).select(*CELL, F.lit(float(r)).alias("resolution"), "cluster")
    with ThreadPoolExecutor(len(resolutions)) as pool:  # at once: a resolution's sweeps leave cores idle
        return reduce(DataFrame.unionByName, pool.map(one, resolutions))


# -- map --------------------------------------------------------------------------------------------------------------


def fuzzy_graph(neighbours: DataFrame, k: int = 20) -> DataFrame:
    """(sample_id, src, dst, weight), src < dst: exp(-max(0, d - rho) / sigma) of neighbours, both ways joined as a + b - ab.

    rho is the least distance above 0; sigma is found by 64 halvings so that a cell's weights sum to log2 k.
    """
    goal = float(np.log2(k))
    near = neighbours.where("neighbour_id <> cell_id").groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("dist", "neighbour_id"))).alias("a"))
    dist = F.transform("a", lambda x: x["dist"])
    near = near.withColumn("d", dist).withColumn("rho", F.coalesce(F.array_min(F.filter("d", lambda x: x > 0)), F.lit(0.0)))
    near = near.withColumn("over", let(F.col("rho"), lambda rho: F.transform("d", lambda x: F.greatest(x - rho, F.lit(0.0)))))
    weight = lambda over, sigma: F.aggregate(over, F.lit(0.0), lambda s, x: s + F.exp(-x / sigma))
    start = F.struct(F.lit(0.0).alias("low"), F.lit(float("inf")).alias("high"), F.lit(1.0).alias("mid"))

    def halve(over: Column, s: Column) -> Column:
        much = weight(over, s["mid"]) > goal
        low, high = F.when(much, s["low"]).otherwise(s["mid"]), F.when(much, s["mid"]).otherwise(s["high"])
        return F.struct(low.alias("low"), high.alias("high"), F.when(high == float("inf"), low * 2).otherwise((low + high) / 2).alias("mid"))

    sigma = let(F.col("over"), lambda o: F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, lambda s, _: halve(o, s), lambda s: F.greatest(s["mid"], F.lit(1e-12))))
    rows = near.withColumn("sigma", sigma).select("sample_id", F.col("cell_id").alias("i"), F.inline(let(F.struct("a", "rho", "sigma"), lambda t: F.transform(t["a"], lambda x: F.struct(x["neighbour_id"].alias("j"), F.exp(-F.greatest(x["dist"] - t["rho"], F.lit(0.0)) / t["sigma"]).alias("w"))))))
    pair = rows.select("sample_id", F.least("i", "j").alias("src"), F.greatest("i", "j").alias("dst"), "w")
    each = pair.groupBy("sample_id", "src", "dst").agg(F.sum("w").alias("sum"), F.when(F.count("*") > 1, F.product("w")).otherwise(0.0).alias("both"))
    return each.select("sample_id", "src", "dst", (F.col("sum") - F.col("both")).alias("weight"))


def _ritz(products: np.ndarray, images: np.ndarray) -> np.ndarray:
    """(2, 6): the combinations of six vectors that are best as the two leading eigenvectors, from the vectors' products with each
    other and with their images. Vectors that are zero or depend on others have no part."""
    size = np.sqrt(np.maximum(np.diag(products), 0))
    held = np.flatnonzero(size > 1e-14 * max(size.max(), 1e-300))
    out = np.zeros((2, 6))
    if not len(held):
        return out
    unit = np.diag(1 / size[held])
    d, u = np.linalg.eigh(unit @ products[np.ix_(held, held)] @ unit)
    base = unit @ u[:, d > 1e-10] / np.sqrt(d[d > 1e-10])
    _, z = np.linalg.eigh(base.T @ images[np.ix_(held, held)] @ base)
    best = (base @ z[:, ::-1][:, :2]).T
    out[: len(best), held] = best
    return out


def layout_2d(graph: DataFrame, tolerance: float = 1e-2, rounds: int = 200) -> DataFrame:
    """(sample_id, cell_id, x, y): spectral layout of a fuzzy graph, the start layout of the published map.

    The two leading eigenvectors of the normalised graph besides the trivial one, by locally optimal steps: in each round a join and an aggregate give the images of
    both residuals, sample-wide sums of products of vectors, residuals and last steps (six of them) say how they combine best,
    and a sample is settled when both residuals, |Av - lambda v| of unit vectors, are at most ``tolerance``. Settled samples leave; at
    the bound of rounds this is an error. A round leaves one table; the driver learns how many samples go on and how many leave.
    """
    graph = materialise(graph)  # read several times
    both = graph.select("sample_id", F.col("src").alias("a"), F.col("dst").alias("b"), "weight").union(graph.select("sample_id", "dst", "src", "weight"))
    degree = materialise(both.groupBy("sample_id", "a").agg(F.sum("weight").alias("d")))
    left = degree.select("sample_id", "a", F.col("d").alias("da"))
    right = degree.select("sample_id", F.col("a").alias("b"), F.col("d").alias("db"))
    edges = materialise(both.join(left, ["sample_id", "a"]).join(right, ["sample_id", "b"]).select("sample_id", "a", "b", (F.col("weight") / F.sqrt(F.col("da") * F.col("db"))).alias("w")))
    unit = lambda seed: F.shiftrightunsigned(F.xxhash64("a", F.lit(seed)), 11) / float(1 << 53) - 0.5
    vectors = [f"v{i}" for i in range(6)]  # two vectors, their residuals, their last steps
    images = [f"i{i}" for i in range(6)]
    pairs = [(i, j) for i in range(6) for j in range(i + 1)]

    def with_images(v: DataFrame, names: Sequence[str], out: Sequence[str]) -> DataFrame:
        sent = edges.join(v.select("sample_id", F.col("a").alias("b"), *names), ["sample_id", "b"])
        return v.join(sent.groupBy("sample_id", "a").agg(*[F.sum(F.col("w") * F.col(n)).alias(o) for n, o in zip(names, out, strict=True)]), ["sample_id", "a"])

    def weighed(v: DataFrame) -> DataFrame:
        """A row a sample, written: how its six vectors combine to the next two (c0, c1), and of those l (v'Av), q (|Av|^2) and t (part of the trivial one)."""
        dot = lambda x, y: F.sum(F.col(x) * F.col(y))
        sums = {"g": [dot(vectors[i], vectors[j]) for i, j in pairs], "h": [dot(vectors[i], images[j]) for i, j in pairs], "m": [dot(images[i], images[j]) for i, j in pairs], "o": [dot("t", n) for n in vectors]}
        rows = v.groupBy("sample_id").agg(*[F.array(*x).alias(n) for n, x in sums.items()], dot("t", "t").alias("tt"))

        def square(flat: np.ndarray) -> np.ndarray:
            out = np.zeros((6, 6))
            for (i, j), x in zip(pairs, flat, strict=True):
                out[i, j] = out[j, i] = x
            return out

        def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for r in batch.itertuples():
                    c = _ritz(square(r.g), square(r.h))
                    out.append((r.sample_id, *c, *[np.einsum("ki,ij,kj->k", c, square(x), c) for x in (r.h, r.m)], c @ np.asarray(r.o) / r.tt))
                yield pd.DataFrame(out, columns=["sample_id", "c0", "c1", "l", "q", "p"])

        return materialise(rows.mapInPandas(solve, "sample_id string, " + ", ".join(f"{n} array<double>" for n in ("c0", "c1", "l", "q", "p"))))

    def combined(v: DataFrame, weights: DataFrame) -> DataFrame:
        """New vectors and steps, with their images, from all six."""
        mix = lambda names, c, first: reduce(lambda x, y: x + y, [F.get(c, F.lit(i)) * F.col(names[i]) for i in range(first, 6)])
        new = {}
        for k in (0, 1):
            for names, kind in ((vectors, "v"), (images, "i")):
                new[f"{kind}{k}"], new[f"{kind}{4 + k}"] = mix(names, f"c{k}", 0), mix(names, f"c{k}", 2)
        return v.join(weights, "sample_id").select("sample_id", "a", "t", *[e.alias(n) for n, e in new.items()], "l", "q", "p")

    zero = [F.lit(0.0).alias(n) for i in range(2, 6) for n in (vectors[i], images[i])]
    start = degree.select("sample_id", "a", F.sqrt("d").alias("t"), unit(1).alias("v0"), unit(2).alias("v1"))
    along = start.groupBy("sample_id").agg(*[(F.sum(F.col(f"v{k}") * F.col("t")) / F.sum(F.col("t") * F.col("t"))).alias(f"_{k}") for k in (0, 1)])
    start = start.join(along, "sample_id").select("sample_id", "a", "t", *[(F.col(f"v{k}") - F.col(f"_{k}") * F.col("t")).alias(f"v{k}") for k in (0, 1)])
    now = materialise(with_images(materialise(start), ["v0", "v1"], ["i0", "i1"]).select("*", *zero))
    done = materialise(now.select("sample_id", "a", "t", "v0", "v1").limit(0))
    at = lambda name, k: F.get(name, F.lit(k))
    settled = F.greatest(*[at("q", k) - at("l", k) * at("l", k) for k in (0, 1)]) <= tolerance * tolerance
    for _ in range(rounds + 1):
        weights = weighed(now)
        state = combined(now, weights)
        leaving, going = weights.agg(F.count_if(settled), F.count_if(~settled)).first()
        if leaving:
            done = materialise(done.unionByName(state.where(settled).select(done.columns)))
        if not going:
            break
        rest = [(F.col(f"i{k}") - at("l", k) * F.col(f"v{k}") - (1 - at("l", k)) * at("p", k) * F.col("t")).alias(f"v{2 + k}") for k in (0, 1)]
        kept = materialise(state.where(~settled).select("sample_id", "a", "t", *[n for k in (0, 1, 4, 5) for n in (f"v{k}", f"i{k}")], *rest))
        before, now = now, materialise(with_images(kept, ["v2", "v3"], ["i2", "i3"]))
        forget(before, weights, kept)
    else:
        raise RuntimeError(f"layout_2d did not settle in {rounds} rounds")
    return done.select("sample_id", F.col("a").alias("cell_id"), F.try_divide("v0", "t").alias("x"), F.try_divide("v1", "t").alias("y"))


def cluster_labels_2d(layout: DataFrame, labels: DataFrame) -> DataFrame:
    """Where each cluster's label goes: the median of its cells' positions."""
    by = ["sample_id", "resolution", "cluster"]
    axes = F.explode(F.array(*[F.struct(F.lit(n).alias("axis"), F.col(n).cast("double").alias("at")) for n in ("x", "y")])).alias("p")
    middle = quantiles(layout.join(labels, CELL).select(*by, axes).select(*by, "p.*"), [*by, "axis"], "at", [0.5])
    return middle.groupBy(*by).agg(*[F.max(F.when(F.col("axis") == n, F.get("q", F.lit(0)))).alias(n) for n in ("x", "y")])


# -- cluster tables ---------------------------------------------------------------------------------------------------


def cluster_marker_means(scaled: DataFrame, labels: DataFrame) -> DataFrame:
    """Mean scaled value of each marker in each cluster, and its z-score over the cluster's markers. ``scaled`` is long."""
    means = scaled.join(labels, CELL).groupBy("sample_id", "resolution", "cluster", "marker").agg(F.avg("value").alias("mean"))
    w = Window.partitionBy("sample_id", "resolution", "cluster")
    return means.withColumn("z", F.try_divide(F.col("mean") - F.avg("mean").over(w), F.stddev_samp("mean").over(w)))


def cluster_marker_density(values: DataFrame, labels: DataFrame, points: int = 512) -> DataFrame:
    """Density of each marker in each cluster over its range, with the sample's overall limits for a shared axis."""
    joined = values.join(labels, CELL)
    limits = joined.groupBy("sample_id", "resolution").agg(F.min("value").alias("axis_low"), F.max("value").alias("axis_high"))
    return density(joined, ["sample_id", "resolution", "cluster", "marker"], "value", points).join(limits, ["sample_id", "resolution"])


def palette(n: int = 30) -> list[str]:
    """``n`` colours of evenly turned hue, as hex."""
    import colorsys

    return ["#" + "".join(f"{round(255 * c):02X}" for c in colorsys.hls_to_rgb(i / n, 0.45 + 0.15 * (i % 3), 0.65)) for i in range(n)]


def spatial_map(cells: DataFrame, labels: DataFrame, colours: Sequence[str] | None = None) -> DataFrame:
    """x is Y_centroid and y is X_centroid, as the report draws them; a colour by cluster number, over again past the last."""
    colours = F.array(*map(F.lit, colours or palette()))
    at = cells.select(*CELL, F.col("Y_centroid").alias("x"), F.col("X_centroid").alias("y"))
    return at.join(labels, CELL).withColumn("colour", F.get(colours, (F.col("cluster") % F.size(colours)).cast("int")))


def spatial_marker_map(cells: DataFrame, markers: Sequence[str]) -> DataFrame:
    at = cells.select(*CELL, F.col("Y_centroid").alias("x"), F.col("X_centroid").alias("y"), *[F.col(f"`{m}`") for m in markers])
    return at.unpivot([*CELL, "x", "y"], [F.col(f"`{m}`") for m in markers], "marker", "value")
