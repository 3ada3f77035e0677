import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.llm import helpers as h
from tissuemill.llm import queries, sharding

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version"]


def held(rows):
    """Bytes and places by shard."""
    size, places = Counter(), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        places[r.shard].append(r.slot)
    return size, places


def test_sizes_checksums_places_and_the_law(spark):
    rng = random.Random(2)
    texts = [None, "", "é ü", "x" * 5000, *("".join(rng.choice("abc é") for _ in range(rng.randrange(400))) for _ in range(900))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9, texts[9]), (9, "another text"), (None, "no id"), (None, None)]
    found = sharding.shard(h.frame(spark, rows), shards=7, slots=700)
    got = found.collect()
    assert found.columns == COLUMNS and len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    size, places = held(got)
    assert len(size) == 7 and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 7
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_hot_ids_and_copies(spark):
    """A third of the rows without an id, a third with one text: shards stay even. Equal rows keep one row each."""
    rows = [(None, f"text {i} " * 9) for i in range(600)] + [(i, "the same text " * 5) for i in range(600)] + [(i, f"own {i} " * 8) for i in range(1000, 1600)] + [(5, "repeated")] * 40
    got = sharding.shard(h.frame(spark, rows), shards=5, slots=1000).collect()
    size, places = held(got)
    assert len(got) == len(rows) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 5


def test_runs_of_equal_rows_are_written_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    got = sharding.shard(h.frame(spark, [(5, "repeated")] * 40), shards=2, slots=10).collect()
    assert sorted(r.slot for r in got) == list(range(40)) and len({r.shard for r in got}) == 1


def test_no_rows_and_clashing_columns(spark):
    assert sharding.shard(h.frame(spark, [])).count() == 0
    odd = spark.createDataFrame([("a", "t", 5, "q", 1.0), (None, None, None, None, None)], "doc_id string, text string, shard int, size string, n double")
    assert sharding.shard(odd).count() == 2
    kept = sharding.assigned(odd, sharding.even_map(spark, 3))
    assert set(kept.columns) == {"doc_id", "text", "n", "size", "text_crc32", "virtual_slot", "shard"} and kept.count() == 2


def test_long_text(spark):
    text = "é" * 3_000_000
    got = sharding.shard(h.frame(spark, [(1, text), (2, "b")])).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(1, 6_000_008, zlib.crc32(text.encode())), (2, 9, zlib.crc32(b"b"))}


def test_a_rebalancing_moves_few_slots_and_is_a_version(spark, tmp_path):
    rng = random.Random(4)
    sizes = spark.createDataFrame([(i, 1000 + rng.randrange(300), 1) for i in range(480)], "virtual_slot int, bytes long, rows long")
    path = str(tmp_path / "map")
    sharding.write_map(sharding.even_map(spark, 8, 480), path, 0)
    one = sharding.rebalanced(sharding.read_map(spark, path), sizes, 8)
    sharding.write_map(one, path, 1)
    with pytest.raises(Exception, match="already exists"):
        sharding.write_map(one, path, 1)
    before, after = ({r.virtual_slot: r.shard for r in sharding.read_map(spark, path, v).collect()} for v in (0, 1))
    assert len(before) == len(after) == 480 and 0 < sum(before[s] != after[s] for s in before) < 48
    load = Counter()
    by = {r.virtual_slot: r.bytes for r in sizes.collect()}
    for s, k in after.items():
        load[k] += by[s]
    assert max(load.values()) - min(load.values()) <= 1300
    assert {r.version for r in sharding.read_map(spark, path).collect()} == {1}


def test_one_more_shard_takes_slots_only_into_itself(spark):
    sizes = spark.createDataFrame([(i, 1000 + 7 * i % 300, 1) for i in range(480)], "virtual_slot int, bytes long, rows long")
    old = sharding.even_map(spark, 8, 480)
    new = {r.virtual_slot: r.shard for r in sharding.grown(old, sizes, 8).collect()}
    assert len(new) == 480 and all(new[r.virtual_slot] in (r.shard, 8) for r in old.collect())
    load, by = Counter(), {r.virtual_slot: r.bytes for r in sizes.collect()}
    for s, k in new.items():
        load[k] += by[s]
    assert len(load) == 9 and max(load.values()) < 1.25 * sum(load.values()) / 9


def test_shards_are_written_whole(spark, tmp_path):
    docs = h.frame(spark, [(i, f"text {i}") for i in range(200)])
    sharding.write_shards(docs, sharding.even_map(spark, 4), str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(200)) and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_too_many_slots_or_shards(spark):
    for shards, slots in ((0, 10), (11, 10), (2, sharding.MOST_SLOTS + 1)):
        with pytest.raises(ValueError):
            sharding.even_map(spark, shards, slots)


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.op11_sharding(spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
    assert got == sorted(con.execute(queries.ORACLES["op11_sharding"]).fetchall()) and len(got) == 200
