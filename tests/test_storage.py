import os

from tissuemill.functions.storage import bucketed, forget, materialise, settled


def folder(df):
    return df.inputFiles()[0].rpartition("/")[0].removeprefix("file://").removeprefix("file:")


def test_settled_leaves_its_result_only(spark):
    before = len(spark.catalog.listTables())
    made = []

    def make():
        a = materialise(spark.range(10))
        b = bucketed(a.withColumnRenamed("id", "k"), "k")
        inner = settled(spark, lambda: materialise(b).where("k > 3"))
        made.extend([folder(a), folder(b), folder(inner)])
        return a.join(inner.withColumnRenamed("k", "id"), "id")

    got = settled(spark, make)
    assert sorted(r.id for r in got.collect()) == list(range(4, 10))
    assert not any(os.path.exists(f) for f in made) and os.path.exists(folder(got))
    assert len(spark.catalog.listTables()) == before


def test_settled_cleans_up_after_a_failure(spark):
    made = []

    def make():
        made.append(folder(materialise(spark.range(3))))
        raise RuntimeError("stop")

    try:
        settled(spark, make)
    except RuntimeError:
        pass
    assert made and not os.path.exists(made[0])


def test_forget_drops_bucketed_tables(spark):
    before = len(spark.catalog.listTables())
    table = bucketed(spark.range(8), "id")
    where = folder(table)
    assert len(spark.catalog.listTables()) == before + 1
    forget(table)
    assert len(spark.catalog.listTables()) == before and not os.path.exists(where)
