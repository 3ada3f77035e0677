import numpy as np
import pytest
from pyspark.sql import functions as F

from tissuemill.functions.quantiles import quantiles


@pytest.mark.parametrize("accuracy", [50, 200, 10_000])
def test_quantiles_equal_percentile(spark, accuracy):
    """Groups below and above the bound, ties, a heavy tail, infinities, NaN, nulls, one value and none."""
    rng = np.random.default_rng(2)
    groups = {
        "normal": rng.normal(size=6000), "ties": rng.integers(0, 4, 5000).astype(float), "tail": np.exp(rng.normal(size=6000) * 30),
        "same": np.full(3000, 2.5), "few": rng.random(7), "one": [4.0], "infinite": [*rng.random(2000), *[np.inf] * 900, *[-np.inf] * 900], "none": [None, None],
    }
    rows = [(k, None if x is None else float(x)) for k, v in groups.items() for x in v] + [("few", None), ("ties", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    points = [0.0, 0.01, 0.25, 0.5, 0.995, 1.0]
    got = {r["g"]: (r["n"], r["q"]) for r in quantiles(df, ["g"], "v", points, [F.count("*").alias("n")], accuracy).collect()}
    want = {r["g"]: (r["n"], r["q"] or [None] * 6) for r in df.groupBy("g").agg(F.count("*").alias("n"), F.percentile("v", F.array(*map(F.lit, points))).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][0] == want[g][0]
        assert all(a is b or a == pytest.approx(b, rel=1e-12) for a, b in zip(got[g][1], want[g][1], strict=True)), g


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([("a", float(i) if i < 300 else float("nan")) for i in range(401)], "g string, v double")
    q = quantiles(df, ["g"], "v", [0.5, 0.9], accuracy=20).first()["q"]
    assert q[0] == 200 and np.isnan(q[1])
    assert quantiles(df.where("v < 0"), ["g"], "v", [0.5]).collect() == []
