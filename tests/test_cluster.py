import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.test_jobs import SF
from tissuemill.jobs import workloads
from tissuemill.operators import cluster


def test_density_query_has_every_marker_and_the_whole_grid(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").limit(60)
    got = entry.queries()["c10_cluster_marker_density"](spark, saved(spark, rows)).toPandas()
    frame = rows.toPandas()
    frame["sample"] = "s" + (frame.vec_id % 2).astype(str)
    x = np.stack(frame.embedding).astype(float)
    groups = frame[["sample", "label"]].drop_duplicates()
    assert set(got.marker) == {f"m{i}" for i in range(64)} and len(got) == len(groups) * 64 * 512
    for sample, part in got.groupby("sample_id"):
        own = x[(frame["sample"] == sample).to_numpy()]
        assert np.allclose(part.axis_low, own.min(), atol=1e-3) and np.allclose(part.axis_high, own.max(), atol=1e-3)


def saved(spark, rows):
    from tissuemill.functions.storage import shared_dir

    folder = shared_dir(spark)
    rows.write.parquet(f"{folder}/embeddings.parquet")
    return folder


def fixture(spark):
    """Sample a of 30 cells, sample b of 90; two groups in each, and labels that follow them."""
    rng = np.random.default_rng(3)
    rows = [(s, i, [float(x) for x in rng.normal(8 * (i % 2), 1, 3)]) for s, n in (("a", 30), ("b", 90)) for i in range(n)]
    features = spark.createDataFrame(rows, "sample_id string, cell_id long, v array<double>")
    return features, features.selectExpr("sample_id", "cell_id", "1.0D AS resolution", "int(cell_id % 2) AS cluster")


def test_only_samples_over_the_limit_are_sketched(spark):
    features, labels = fixture(spark)
    drawn = cluster.sketch(features, 50, 20)
    assert {r["sample_id"]: r["count"] for r in drawn.groupBy("sample_id").count().collect()} == {"a": 30, "b": 20}
    points = features.withColumnRenamed("v", "pc")
    odd = labels.withColumn("cluster", F.when(F.expr("sample_id = 'a' and cell_id = 0"), 7).otherwise(F.col("cluster")))  # a vote would lose it
    got = cluster.labels_of_all(drawn.withColumnRenamed("v", "pc"), odd, points, 5, 50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, odd.collect()))


@pytest.mark.parametrize("name", ["t4_leverage_sample", "c7_transfer_labels"])
def test_queries_take_small_samples_whole(spark, name):
    got = entry.queries()[name](spark, SF)
    cells = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert got.count() == cells.count()
    if name == "c7_transfer_labels":
        assert {r["cell_id"]: r["cluster"] for r in got.collect()} == {r["vec_id"]: r["label"] for r in cells.collect()}


def test_cluster_tables_sketch_each_sample_by_its_own_size(spark):
    rng = np.random.default_rng(4)
    rows = [(s, i, float(i), float(i), *(float(x) for x in rng.gamma(2, 1, 3) + np.array([9 * (i % 2), 9 * (1 - i % 2), 1]))) for s, n in (("a", 30), ("b", 90)) for i in range(n)]
    cells = spark.createDataFrame(rows, "sample_id string, cell_id long, X_centroid double, Y_centroid double, DAPI double, CD3 double, CD8 double")
    both = workloads.cluster_tables(cells, ["DAPI", "CD3", "CD8"], (0.2,), k=8, components=2, limit=50, sketch=20)
    for name in ("clusters", "layout"):
        assert {tuple(r) for r in both[name].select("sample_id", "cell_id").collect()} == {(r[0], r[1]) for r in rows}
    assert both["layout"].where("isnan(x) or isnan(y) or x is null or y is null").count() == 0


def test_layout_of_all_moves_only_cells_outside_the_sketch(spark):
    features, _ = fixture(spark)
    points = features.withColumnRenamed("v", "pc")
    drawn = points.where("sample_id = 'a' or cell_id < 20")
    layout = drawn.select("sample_id", "cell_id", (F.col("cell_id") % 2).cast("double").alias("x"), F.lit(3.0).alias("y"))
    got = cluster.layout_of_all(drawn, layout, points, 5, 50).toPandas()
    assert len(got) == 120 and np.allclose(got.x, got.cell_id % 2) and np.allclose(got.y, 3)


def test_louvain_has_all_resolutions_and_raises_at_its_bounds(spark, monkeypatch):
    pairs = [(s, 10 * g + i, 10 * g + j, 1.0) for s, m in (("a", 1), ("b", 3)) for g in range(m) for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame(pairs, "sample_id string, src long, dst long, weight double")
    groups = {}
    for r in cluster.louvain(edges).collect():
        groups.setdefault((r["sample_id"], r["cluster"]), set()).add(r["cell_id"] // 10)
    assert sorted(map(str, groups.values())) == ["{0}", "{0}", "{1}", "{2}"]
    with pytest.raises(RuntimeError):
        cluster.louvain(edges, sweeps=1)
    monkeypatch.setattr(cluster, "louvain", lambda edges, r, cells=None: edges.selectExpr("sample_id", "src AS cell_id", "0 AS cluster"))
    got = entry.queries()["c6_louvain"](spark, SF)
    assert {r[0] for r in got.select("resolution").distinct().collect()} == {0.25, 0.5, 0.75, 1.0}


def cloud(spark, n=900, dim=3, groups=12, seed=8):
    """Points in tight groups, some of them the same, in two samples of different size."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 30, (groups, dim))
    points = {s: np.concatenate([middles[rng.integers(0, groups, m)] + rng.normal(0, 1, (m, dim)), np.tile(middles[0], (m // 6, 1))]) for s, m in (("a", n), ("b", n // 9))}
    rows = [(s, i, [float(v) for v in p]) for s, x in points.items() for i, p in enumerate(x)]
    return points, spark.createDataFrame(rows, "sample_id string, cell_id long, pc array<double>")


def brute_near(queries, data, k):
    d = np.sqrt(((queries[:, None] - data[None]) ** 2).sum(axis=2))
    order = np.lexsort((np.broadcast_to(np.arange(len(data)), d.shape), d), axis=1)[:, :k]
    return {(i, r + 1, int(j)) for i, row in enumerate(order) for r, j in enumerate(row)}


def test_neighbours_are_exact_and_far_blocks_are_skipped(spark):
    points, df = cloud(spark)
    block = 40
    got = {}
    for r in cluster.knn(df, 7, block).collect():
        got.setdefault(r["sample_id"], set()).add((r["cell_id"], r["rank"], r["neighbour_id"]))
    for s, x in points.items():
        assert got[s] == brute_near(x, x, 7)
    cells, blocks = cluster.partitioned(df, block)
    assert cells.groupBy("sample_id", "j", "sub").count().agg(F.max("count")).first()[0] <= 3 * block  # also where a sixth is one point
    pivots = {r["sample_id"]: len(r["blocks"]) for r in blocks.collect()}
    assert pivots["a"] > pivots["b"] > 1
    met = cluster._sent(df, blocks, cells, 7, block, "pc")[1].where("sample_id = 'a'")
    n = len(points["a"])
    total = n * (cells.where("sample_id = 'a'").select("j", "sub").distinct().count() - 1)
    asked = met.groupBy("cell_id").count().agg(F.sum("count")).first()[0] / 7  # neighbours that came from further blocks, seven a block
    assert asked < 0.35 * total


def test_queries_meet_a_broadcast_sketch_where_they_are(spark):
    points, df = cloud(spark, 300)
    sketch = df.where("cell_id % 5 = 0")
    want = {s: {(i, r, int(j) * 5) for i, r, j in brute_near(x, x[::5], 6)} for s, x in points.items()}
    for most in (1 << 20, 10):  # as a broadcast, and by blocks beyond the bound
        found = cluster.nearest_broadcast(df, sketch, 6, most)
        got = {}
        for r in found.collect():
            got.setdefault(r["sample_id"], set()).add((r["cell_id"], r["rank"], r["neighbour_id"]))
        assert got == want
    plan = cluster.nearest_broadcast(df, sketch, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the full side stays


def test_leverage_sample_ranks_one_range_only(spark):
    """The draw is that of a plain sort of race keys; the plan ranks what the counts have left over."""
    rng = np.random.default_rng(9)
    rows = [(s, i, [float(v) for v in rng.gamma(1, 2, 3)]) for s, n in (("a", 700), ("b", 40)) for i in range(n)]
    features = spark.createDataFrame(rows, "sample_id string, cell_id long, v array<double>")
    got = {(r["sample_id"], r["cell_id"]) for r in cluster.leverage_sample(features, 100).collect()}
    key = -F.log(cluster._uniform(0)) / F.greatest("leverage", F.lit(1e-12))
    raced = [(r["sample_id"], r["k"], r["cell_id"]) for r in cluster.leverage_scores(features).withColumn("k", key).collect()]
    want = {(s, i) for t in "ab" for s, _, i in sorted(x for x in raced if x[0] == t)[:100]}
    assert got == want and sum(s == "a" for s, _ in got) == 100 and sum(s == "b" for s, _ in got) == 40


@pytest.mark.parametrize("n", [1, 50, 97, 300, 5000])
def test_first_rows_equal_a_sort(spark, n):
    from tissuemill.functions.selection import first_rows

    rng = np.random.default_rng(n)
    rows = [(g, i, int(k)) for g, m in (("x", 400), ("y", 60)) for i, k in enumerate(rng.integers(0, 40, m))]  # many ties
    df = spark.createDataFrame(rows, "g string, i int, k int")
    got = sorted(map(tuple, first_rows(df, ["g"], n, [F.floor(F.col("k") / 16), F.col("k")], [F.col("k"), F.col("i")]).collect()))
    assert got == sorted(r for g in "xy" for r in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]))[:n])


def test_louvain_tells_the_driver_one_number_a_sweep(spark):
    """A sample of its own is clustered as in a run of many; no list of samples is in a plan."""
    pairs = [(f"s{s}", 10 * g + i, 10 * g + j, 1.0) for s in range(6) for g in range(1 + s % 3) for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame(pairs, "sample_id string, src long, dst long, weight double")
    found = cluster.louvain(edges)
    alone = cluster.louvain(edges.where("sample_id = 's4'"))
    assert sorted(map(tuple, found.where("sample_id = 's4'").collect())) == sorted(map(tuple, alone.collect()))
    assert {r["sample_id"]: r["n"] for r in found.groupBy("sample_id").agg(F.countDistinct("cluster").alias("n")).collect()} == {f"s{s}": 1 + s % 3 for s in range(6)}


def normalised(edges, n):
    w = np.zeros((n, n))
    for a, b, x in edges:
        w[a, b] = w[b, a] = x
    d = w.sum(axis=1)
    return w / np.sqrt(np.outer(d, d)), d


def test_layout_settles_on_a_long_chain(spark, monkeypatch):
    """The leading vectors of a chain, where plain power iteration crawls; a small sample beside it leaves early."""
    n = 60
    chain = [(i, i + 1, 1.0) for i in range(n - 1)]
    ring = [(i, (i + 1) % 5, 1.0 + i) for i in range(5)]
    graph = spark.createDataFrame([("chain", min(a, b), max(a, b), w) for a, b, w in chain] + [("ring", min(a, b), max(a, b), w) for a, b, w in ring], "sample_id string, src long, dst long, weight double")
    got = cluster.layout_2d(graph, 1e-3).toPandas()
    for name, edges, m in (("chain", chain, n), ("ring", ring, 5)):
        a, d = normalised(edges, m)
        own = got[got.sample_id == name].sort_values("cell_id")
        assert own.cell_id.tolist() == list(range(m))
        v = own[["x", "y"]].to_numpy() * np.sqrt(d)[:, None]
        values = np.linalg.eigvalsh(a)[::-1]
        for k in (0, 1):
            u = v[:, k] / np.linalg.norm(v[:, k])
            ray = u @ a @ u
            assert np.linalg.norm(a @ u - ray * u) <= 1.01e-3 and abs(ray - values[k + 1]) < 1e-3 and abs(u @ np.sqrt(d)) < 1e-6
        assert abs(v[:, 0] @ v[:, 1]) < 1e-6 * np.linalg.norm(v[:, 0]) * np.linalg.norm(v[:, 1])
    with pytest.raises(RuntimeError, match="did not settle"):
        cluster.layout_2d(graph, 1e-6, rounds=2)


def communities(spark, seed=5):
    """Edges of two samples with planted groups, names of different length, some weights alike."""
    rng = np.random.default_rng(seed)
    rows = []
    for s, n in (("a", 60), ("b", 20)):
        i, j = np.triu_indices(n, 1)
        held = rng.random(len(i)) < np.where(i % 6 == j % 6, 0.35, 0.03)
        rows += [(s, int(x) * 7, int(y) * 7, float(w)) for x, y, w in zip(i[held], j[held], rng.integers(1, 5, held.sum()) / 8, strict=True)]
    return spark.createDataFrame(rows, "sample_id string, src long, dst long, weight double")


def test_louvain_in_tasks_equals_the_sweeps_over_tables(spark, monkeypatch):
    edges = communities(spark)
    alone = {"n": 0}
    kept = cluster._settled_in_tasks

    def counted(*args):
        alone["n"] += 1
        return kept(*args)

    monkeypatch.setattr(cluster, "_settled_in_tasks", counted)
    found = sorted(map(tuple, cluster.louvain(edges, 0.9).collect()))
    assert alone["n"] == 1 and len({r[:2] for r in found}) > 70 and len({r[2] for r in found}) > 2
    monkeypatch.setattr(cluster, "MOST_ROWS", 300)  # by tables first, from some level on in tasks
    assert sorted(map(tuple, cluster.louvain(edges, 0.9).collect())) == found


def test_hash_of_a_sweep_is_that_of_spark(spark):
    names = spark.range(50).selectExpr("cast(id * 7919 AS string) AS node")
    for number in (0, 7, 4999):
        rows = names.select(F.xxhash64("node").alias("h"), F.xxhash64("node", F.lit(number)).alias("want")).toPandas()
        assert cluster._int_hash(number, rows.h.to_numpy().view(np.uint64)).view(np.int64).tolist() == rows.want.tolist()


def test_neighbours_in_many_parts_are_met_in_place(spark, monkeypatch):
    """Exact, ties by id, ids of text; no query is shuffled."""
    points, df = cloud(spark, 400, 16)
    kept = cluster.by_sample
    monkeypatch.setattr(cluster, "by_sample", lambda rows: kept(rows, 1 << 14))  # several row groups
    plan = cluster.knn(df, 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for name in (lambda c: c, lambda c: F.format_string("c%06d", c)):
        got = {}
        for r in cluster.knn(df.withColumn("cell_id", name(F.col("cell_id"))), 7).collect():
            got.setdefault(r["sample_id"], set()).add(tuple(int(str(r[c]).lstrip("c0") or 0) for c in ("cell_id", "rank", "neighbour_id")))
        for s, x in points.items():
            assert got[s] == brute_near(x, x, 7)


def test_shared_neighbours_are_counted_in_place(spark):
    """Against brute force, with a cell that is everyone's neighbour and cells of equal sets; pairs are not shuffled."""
    rng = np.random.default_rng(11)
    for kind, name in (("long", int), ("string", lambda i: f"c{i:04d}")):
        sets = {(s, i): {0} | set(rng.choice(np.arange(1, n), 7, replace=False).tolist()) if i % 5 else set(range(8)) for s, n in (("a", 90), ("b", 30)) for i in range(n)}
        rows = [(s, name(i), name(x), r + 1, 1.0) for (s, i), held in sets.items() for r, x in enumerate(sorted(held))]
        near = spark.createDataFrame(rows, f"sample_id string, cell_id {kind}, neighbour_id {kind}, rank int, dist double")
        edges = cluster.snn(near, 8, 1 / 4)
        plan = edges._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        want = {}
        for (s, i), held in sets.items():
            for (t, j), other in sets.items():
                common = len(held & other)
                if s == t and i < j and common / (16 - common) >= 1 / 4:
                    want[s, name(i), name(j)] = common / (16 - common)
        got = [tuple(r) for r in edges.collect()]
        assert len(got) == len(want) and {r[:3]: r[3] for r in got} == want


def test_pairs_of_one_common_neighbour_come_in_bounded_parts():
    n = 300
    row, key = np.repeat(np.arange(n), 2), np.tile([5, 9], n)
    sets = cluster._Sets(row, key, n, 2)
    parts = list(sets.shared(row, key, lambda i, j: i < j, 5000))
    assert len(parts) > 10 and max(len(i) for i, _, _ in parts) <= 5000
    assert sum(len(i) for i, _, _ in parts) == n * (n - 1) // 2 and all((s == 2).all() for _, _, s in parts)


def test_fuzzy_graph_of_features_shuffles_lists_and_pairs_only(spark):
    plan = entry.queries()["c8_fuzzy_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
