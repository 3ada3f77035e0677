import hashlib
import random

import duckdb
import numpy as np
import pytest

from tissuemill.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, rounds, dim, scale=256):
    """The contract's columns by plain Python numbers."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))

    def near(v):
        d, j = min((far(v, c), j) for j, c in enumerate(centres))
        return j, d

    for _ in range(rounds):
        mine = [near(v)[0] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), m in zip(kept, mine, strict=True) if m == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = [near(v) for _, v in kept]
    per = [sum(d for j, d in last if j == c) for c in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, per[j], sum(per), digest[j]) for (i, _), (j, d) in zip(kept, last, strict=True)), key=str)


def made(spark, rows, **kw):
    return sorted((tuple(r) for r in centroids.cluster(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_equals_brute_force(spark, spread):
    rng = random.Random(spread)
    middles = [[rng.gauss(0, 1) for _ in range(13)] for _ in range(6)]
    rows = [(i, [rng.gauss(m, spread) for m in middles[i % 6]], 0) for i in range(150)]
    rows += [(500 + i, rows[0][1], 0) for i in range(60)] + [(7, rows[7][1], 0), (7, rows[9][1], 0), (None, rows[3][1], 0)]  # copies, repeated and null ids
    inf, nan = float("inf"), float("nan")
    rows += [(900, None, 0), (901, [], 0), (902, rows[0][1][:-1], 0), (903, [None, *rows[0][1][1:]], 0), (904, [nan, *rows[0][1][1:]], 0), (905, [-inf, *rows[0][1][1:]], 0)]
    assert made(spark, rows, k=9, rounds=4, dim=13) == brute(rows, 9, 4, 13)


def test_ties_and_empty_clusters(spark):
    rows = [(i, [float(i % 3), 0.0], 0) for i in range(30)]  # nine starts on three points: six centroids lose all
    assert made(spark, rows, k=9, rounds=3, dim=2) == brute(rows, 9, 3, 2)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, -0.25], 0), (2, [3.0, 1.0], 0)]
    assert made(spark, rows, k=40, dim=2) == brute(rows, 40, 5, 2)
    assert made(spark, [], k=40, dim=2) == [] and made(spark, [(1, [1.0], 0)], k=40, dim=2) == []


def test_components_beyond_the_bound_are_an_error(spark):
    large = 0.9 * (2**61 / 2) ** 0.5 / 256
    rows = [(1, [large, -large], 0), (2, [-large, large], 0), (3, [0.0, 0.0], 0)]
    assert made(spark, rows, k=2, rounds=2, dim=2) == brute(rows, 2, 2, 2)
    with pytest.raises(Exception, match="no distance in 64 bits"):
        made(spark, [(1, [1e30, 0.0], 0)], k=1, dim=2)


def test_bounds_are_never_above_the_distance_and_screen():
    rng = np.random.default_rng(5)
    middles = rng.integers(-2000, 2000, (40, 64))
    x = middles[rng.integers(0, 40, 3000)] + rng.integers(-300, 300, (3000, 64))
    short = centroids.compressed(x)
    d = ((x[:, None] - middles) ** 2).sum(axis=2)
    low = ((short[:, None] - centroids.compressed(middles)) ** 2).sum(axis=2)
    assert (low <= d * (1 + 1e-9)).all()
    who, best, exact = centroids.nearest(x, short, middles)
    assert (who == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact.mean() < 4  # of 40


def test_other_ids_and_clashing_columns(spark):
    rows = [("a", [1.0, 2.0], 5, "x", 1), ("b", [4.0, 2.0], 5, "x", 1), (None, [1.0, 2.0], None, None, None)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>, cluster int, v string, distance int")
    got = centroids.cluster(df, k=2, dim=2)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and got.count() == 3


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.op12_centroid_clustering(spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{sf_dir}/embeddings.parquet'")
    assert got == sorted(con.execute(queries.ORACLES["op12_centroid_clustering"]).fetchall()) and len(got) == 500
