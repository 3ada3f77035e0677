import random

import corpus_pipeline
from tests.llm import helpers as h
from tests.llm import test_near_copies as near_copies
from tissuemill.llm.queries import ORACLES, QUERIES


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    item, shared = text(30), text(40)
    rows = [(i, text(60), "en", f"s{i % 3}", 1) for i in range(20)]
    rows += [(30, rows[2][1], "en", "s0", 1), (31, rows[4][1] + " end", "en", "s1", 1), (32, text(20) + " " + item + " " + text(20), "en", "s1", 1)]
    rows += [(33, text(30) + " " + shared, "en", None, 1), (34, text(30) + " " + shared + " " + text(5), "en", "s2", 1), (35, "1234 !!", "en", "s2", 1), (36, None, None, "s2", 1)]
    docs = h.frame(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    left = [r for r in rows if r[0] not in (35, 36)]  # no letter
    stay = set(near_copies.kept([(r[0], r[1]) for r in left]))  # five words, similarity of 0.8 or more
    left = [r for r in left if r[0] in stay]
    assert not {30, 31} & stay
    want, seen = {}, set()
    for i, t, *_ in sorted(left):
        gone = bytearray(len(t))
        for s in range(len(t) - 99):
            if t[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(t[s : s + 100])
        want[i] = "".join(c for c, g in zip(t, gone) if not g)
    del want[32]  # holds the benchmark item
    assert {i: r["text"] for i, r in got.items()} == want
    assert len({r["mix_position"] for r in got.values()}) == len(got)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = h.frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and out.columns[: len(docs.columns)] == docs.columns


def test_stages_keep_extra_columns_whatever_their_names(spark, tmp_path):
    spark.createDataFrame([(0, "word " * 20)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = ["_key", "_row", "parts", "slots", "until", "nth", "at", "doc", "spans", "fp", "h", "wanted", "a.b"]
    docs = h.frame(spark, [(i, f"text number {i} is here", "en", "s", 1) for i in range(4)] + [(2, "text number 2 is here", "en", "s", 1)])
    for i, name in enumerate(extra):
        docs = docs.selectExpr("*", f"doc_id * 10 + {i} AS `{name}`")
    out = docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns
        rows = out.collect()
        assert sorted(r["doc_id"] for r in rows) in ([0, 1, 2, 2, 3], [0, 1, 2, 3])
        assert all(r[name] == r["doc_id"] * 10 + i for r in rows for i, name in enumerate(extra))
