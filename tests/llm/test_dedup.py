import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import helpers as h
from tissuemill.llm import recompression, repeats, simhash, suffix_dedup
from tissuemill.llm.components import components

SF = "/root/testdata/sf0.001/documents.parquet"
WORDS = [f"w{i}" for i in range(60)]


def passage(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=5):
    rng = random.Random(seed)
    shared = [passage(rng, 80), passage(rng, 55), "x " * 90, "ö" * 130]
    rows = []
    for i in range(60):
        parts = [passage(rng, rng.randrange(60)) for _ in range(3)] + rng.sample(shared, rng.randrange(3))
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    return rows + [(60, rows[3][1]), (61, rows[3][1] + " tail"), (62, ""), (63, None), (64, "a"), (65, "y" * 450), (66, "yz" * 300)]


@given(st.binary(max_size=60) | st.lists(st.sampled_from(b"ab"), max_size=60).map(bytes))
@settings(max_examples=150, deadline=None)
def test_two_stage_sorting_is_a_suffix_array(text):
    got = suffix_dedup.two_stage_suffix_array(np.frombuffer(text, np.uint8), 64).tolist()
    assert got == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_is_brute_force(spark, hot):
    rows = corpus()
    got = suffix_dedup.dedup(h.frame(spark, rows).repartition(5), hot=hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.suffix_dedup(rows)


def test_records_of_long_rows_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 300)
    text = np.frombuffer((passage(random.Random(1), 400)).encode(), np.uint8)
    for bounds in ([0, len(text)], [0, 250, 330, 700, len(text)]):
        h_, row, pos, n = repeats.anchored(suffix_dedup._mixed(text), np.array(bounds), 100, suffix_dedup.GRAM)
        covered = sorted({bounds[r] + x for r, a, k in zip(row.tolist(), pos.tolist(), n.tolist()) for x in range(a, a + k)})
        assert covered == [x for a, z in zip(bounds, bounds[1:]) for x in range(a, z - 99)]


@given(st.lists(st.sampled_from(b"ab"), min_size=1, max_size=80).map(bytes))
@settings(max_examples=100, deadline=None)
def test_common_prefixes(text):
    order = suffix_dedup.two_stage_suffix_array(np.frombuffer(text, np.uint8), 96)
    got = suffix_dedup.common_prefixes(np.frombuffer(text, np.uint8), order, 20)
    want = [0] + [len(os.path.commonprefix([text[a:], text[b:]])) for a, b in zip(order, order[1:])]
    assert got.tolist() == [min(x, 20) for x in want]


def test_which_part_of_the_removal_suffix_arrays_decide(spark, monkeypatch):
    """Without the arrays' verdicts only copies go: windows of a content that is equal, by its digest, to an earlier one."""
    whole = sum(r["n_removed"] for r in suffix_dedup.dedup(h.frame(spark, corpus())).collect())
    judged = suffix_dedup.judged
    monkeypatch.setattr(suffix_dedup, "judged", lambda fetched, length: judged(fetched, length).withColumn("spans", F.array().cast("array<struct<b:long,e:long>>")))
    copies = sum(r["n_removed"] for r in suffix_dedup.dedup(h.frame(spark, corpus())).collect())
    assert 0 < copies < whole


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_suffix_dedup_of_the_test_table(spark):
    docs = spark.read.parquet(SF)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = suffix_dedup.dedup(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.suffix_dedup(rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_substring_dedup_of_the_test_table(spark):
    docs = spark.read.parquet(SF)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = recompression.dedup(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.window_dedup(rows)


def test_long_texts(spark):
    """A text of over 1 MiB, whose end repeats its beginning and another text."""
    rng = random.Random(13)
    head = passage(rng, 400)
    long = head + " " + " ".join(f"{rng.getrandbits(48):x}" for _ in range(100_000)) + " " + head
    assert len(long) > 1 << 20
    rows = [(1, long), (2, passage(rng, 30) + " " + long[-3000:])]
    got = suffix_dedup.dedup(h.frame(spark, rows)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.suffix_dedup(rows)
    got = recompression.dedup(h.frame(spark, rows), room=1000).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.window_dedup(rows)


def test_records_leave_a_large_batch_in_parts():
    data = np.random.default_rng(3).integers(97, 123, 6 << 20, np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array(range(3072)), pa.array([data[2048 * i : 2048 * (i + 1)] for i in range(3072)])], ["_key", "text"])
    parts = list(suffix_dedup.record_batches(iter([batch]), 100))
    windows = sum(sum(p.column("n").to_pylist()) for p in parts)
    assert len(parts) > 1 and max(p.num_rows for p in parts) < 1.2 * suffix_dedup.RECORDS and windows == 3072 * (2048 - 99)


def test_anchors_count_the_records(spark):
    docs = spark.createDataFrame(corpus(), "_key long, text string").coalesce(2)
    found = suffix_dedup.records(docs, 100).groupBy("h").agg(F.sum(1 + F.coalesce(F.size("dups"), F.lit(0))).alias("n"))
    assert sorted(found.collect()) == sorted(suffix_dedup.anchors(docs, 100).groupBy("h").agg(F.sum("n").alias("n")).collect())


def test_suffix_dedup_repeated_ids_nulls_and_empty(spark):
    text = passage(random.Random(2), 60)
    rows = [(1, text), (1, text), (1, None), (None, text), (7, text)]
    got = suffix_dedup.dedup(h.frame(spark, rows)).collect()
    whole = len(text.encode())
    removed = sorted((r["doc_id"] is None, r["n_removed"]) for r in got)
    assert removed == [(False, 0), (False, whole), (False, whole), (False, whole), (True, 0)]  # the null id is first
    assert suffix_dedup.dedup(h.frame(spark, [])).count() == 0


def test_text_without_repeats_keeps_rows_columns_and_characters(spark):
    rows = [(1, "ä" * 30 + passage(random.Random(3), 60)), (2, "é" + passage(random.Random(3), 60)), (3, None)]
    docs = h.frame(spark, rows).withColumnRenamed("source", "spans")
    got = suffix_dedup.without_repeats(docs).orderBy("doc_id").collect()
    assert got[0]["text"] == rows[0][1] and got[1]["text"] == "é" and got[1]["n_chars"] == 1 and got[2]["text"] is None
    assert docs.columns == list(got[0].asDict())


@pytest.mark.parametrize("room", [recompression.CHUNK, 120])
def test_substring_dedup_is_brute_force(spark, room):
    rows = corpus(8) + [(70 + i, "a " * k + "b") for i, k in enumerate((10, 49, 50, 51, 120, 300))]
    got = recompression.dedup(h.frame(spark, rows).repartition(5), room=room).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.window_dedup(rows)


def test_words_are_told_apart_by_their_letters(spark):
    """Two words that a polynomial hash modulo a power of two can't tell apart."""
    bits = [0]
    while len(bits) < 2048:
        bits += [1 - b for b in bits]
    base = " ".join(f"w{i}" for i in range(49))
    rows = [(1, base + " " + "".join("ab"[b] for b in bits)), (2, base + " " + "".join("ba"[b] for b in bits)), (3, base + " " + "".join("ba"[b] for b in bits))]
    got = recompression.dedup(h.frame(spark, rows)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [0, 0, 50]


def test_symbols_agree_inside_equal_windows():
    """With numbers for parts as an oracle gives them, equal windows have equal settled symbols at equal places."""
    rng = random.Random(4)
    middle = [rng.choice([1, 2, 3]) for _ in range(50)]
    names, inside = {}, []
    for _ in range(30):
        left, right = ([rng.choice([1, 2, 3]) for _ in range(rng.randrange(40))] for _ in range(2))
        word = np.array(left + middle + right)
        p = recompression.Parse.of_words(word, np.array([len(word)]))
        for turn in range(4):
            p, want, parts = p.step(turn)
            p.sym[want] = [names.setdefault(tuple(x), len(names) + 10) for x in parts.T.tolist()]
        a = len(left)
        inside.append({(s - a, e - a): x for x, s, e, lo, hi in zip(p.sym.tolist(), p.start.tolist(), p.end.tolist(), p.lo.tolist(), p.hi.tolist()) if lo >= a and hi <= a + 50})
    assert inside[0] and all(x == inside[0] for x in inside)


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30), st.integers(1, 9)), max_size=25))
@settings(max_examples=60, deadline=None)
def test_maximal_runs_of_many_rows(spans):
    row, b, n = (np.array(x, np.int64) for x in (zip(*spans, strict=True) if spans else ((), (), ())))
    _, _, *got = repeats.maximal(row, b, b + n)
    want = [(r, *run) for r in range(5) for run in repeats.merged([(x, x + k) for q, x, k in spans if q == r])]
    assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_substring_dedup_leaves_the_session_as_it_is(spark, monkeypatch):
    name, seen = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", []
    before, named = spark.conf.get(name), recompression.named
    monkeypatch.setattr(recompression, "named", lambda *a: seen.append(spark.conf.get(name)) or named(*a))
    recompression.dedup(spark.createDataFrame(corpus()[:9], "doc_id long, text string"), turns=1)
    assert seen == [str(recompression.LISTS)] * 2 and spark.conf.get(name) == before


@pytest.fixture
def two_rows_a_batch(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 2)
    yield
    spark.conf.set(name, before)


def test_names_come_as_rows_whatever_batches_they_lie_in(spark, two_rows_a_batch):
    """One number for all rows of a key that stands more than once, others have none; no list of a key's chunks is made."""
    rng = random.Random(5)
    rows = [(chunk, nth, key, rng.choice([1, 1, 2])) for chunk in range(6) for nth, key in enumerate(rng.sample([b"%d" % k for k in range(40)], 12))]
    total = {}
    for _, _, key, n in rows:
        total[key] = total.get(key, 0) + n
    names = recompression.named(spark.createDataFrame(rows, "chunk long, nth int, key binary, n long"), ["key"])
    assert [kind for _, kind in names.dtypes] == ["bigint", "int", "bigint"]
    got = {(r["chunk"], r["nth"]): r["id"] for r in names.collect()}
    assert set(got) == {(c, n) for c, n, key, _ in rows if total[key] > 1}
    pairs = {(key, got[c, n]) for c, n, key, _ in rows if (c, n) in got}
    assert len(pairs) == len({key for key, _ in pairs}) == len({i for _, i in pairs}) and all(i > 0 for _, i in pairs)


def test_substring_dedup_in_batches_of_two_rows_is_brute_force(spark, two_rows_a_batch):
    rows = corpus(5)
    got = recompression.dedup(h.frame(spark, rows), turns=1, room=200).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == h.window_dedup(rows)


def test_substring_dedup_edges(spark):
    text = passage(random.Random(6), 70)
    got = recompression.dedup(h.frame(spark, [(2, text), (2, text), (None, text), (3, None), (4, " \t\n")])).collect()
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in got) == [(False, 0), (False, 0), (False, 70), (False, 70), (True, 0)]
    assert recompression.dedup(h.frame(spark, [])).count() == 0


def test_simhash_is_brute_force(spark):
    rng = random.Random(9)
    base = [passage(rng, 200) for _ in range(8)]
    rows = []
    for i in range(60):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS).upper()
        rows.append((i * 3, " ".join(w)))
    rows += [(1, None), (2, ""), (4, "One"), (5, "one"), (7, "one two"), (8, "one two three")]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(h.frame(spark, rows)).collect()}
    marks = [(k, h.simhash(t)) for k, t in rows]
    want = {k: (f"{f:016x}", c) for (k, f), c in zip(marks, h.components(marks))}
    assert got == want


def test_large_blocks_keep_the_same_components(spark):
    rng = random.Random(11)
    start = rng.getrandbits(64)
    marks = {start}
    for _ in range(150):
        marks.add(rng.choice(sorted(marks)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    marks |= {rng.getrandbits(64) for _ in range(50)}
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    df = spark.createDataFrame([(m,) for m in signed], "fp long")
    for limit in (3, 1000):
        got = {r["node"]: r["component"] for r in components(simhash.links(df, block_rows=limit)).collect()}
        want = h.components([(m, m % (1 << 64)) for m in signed])
        assert [got.get(m, m) for m in signed] == want


def test_simhash_edges(spark):
    rows = [(5, "same words here now"), (5, "same words here now"), (None, "same words here now"), (2, "quite other text than that")]
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in simhash.near_duplicates(h.frame(spark, rows)).collect())
    assert got == [(-1, 5), (2, 2), (5, 5), (5, 5)]
    assert simhash.near_duplicates(h.frame(spark, [])).count() == 0
    kept = simhash.keep_one_of_each(h.frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1) for r in kept) == [-1, 2]


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (200, 200)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


BIG = 2**62 + 5


@pytest.mark.parametrize("ids", [[BIG, BIG, 1, 2], [None, None, -(2**63), 5], [None, 2**63 - 1, -(2**63), 7], ["b", "b", "a", None]])
def test_ids_of_any_size_or_type(spark, ids):
    """Repeated, null, very large and text ids, beside a map column: rows are documents, ordered by id and text."""
    text = passage(random.Random(3), 70)
    kind = "string" if isinstance(ids[0], str) else "long"
    docs = spark.createDataFrame([(i, text, {"k": 1}) for i in ids], f"doc_id {kind}, text string, extra map<string,int>")
    for got in (suffix_dedup.dedup(docs).collect(), recompression.dedup(docs).collect()):
        assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(map(str, ids))
        assert sorted(r["n_removed"] > 0 for r in got) == [False, True, True, True]
        first = next(r["doc_id"] for r in got if not r["n_removed"])
        assert first is None if None in ids else first == min(ids)
    kept = suffix_dedup.without_repeats(docs).collect()
    assert sorted(len(r["text"]) for r in kept) == [0, 0, 0, len(text)] and all(r["extra"] == {"k": 1} for r in kept)
