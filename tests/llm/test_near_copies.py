import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import helpers as h
from tissuemill.llm import simhash


def shingles(text):
    w = h.words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept(rows):
    """Ids that stay: the smallest of each group that pairs of Jaccard 0.8 or more connect."""
    rows = sorted(rows)
    parent, sets = list(range(len(rows))), [shingles(t) for _, t in rows]

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [rows[i][0] for i in range(len(rows)) if find(i) == i]


def corpus():
    rng = random.Random(21)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    base = [text(rng.choice((8, 30, 120, 400))) for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(1 + len(w) // 20)):
            w[rng.randrange(len(w))] = rng.choice(("NEW", "w1", "other"))
        rows.append((3 * i, " ".join(w)))
    rows += [(1000 + i, " ".join(text(rng.randrange(1, 60)))) for i in range(40)]
    return rows + [(2000, None), (2001, ""), (2002, "One two"), (2003, "one  two")]


@pytest.mark.parametrize("company", [100_000, 64, 2])
def test_near_copies_are_those_of_brute_force(spark, company):
    rows = corpus()
    got = simhash.keep_one_of_each(h.frame(spark, rows).repartition(5), company=company)
    assert sorted(r["doc_id"] for r in got.collect()) == kept(rows)


def test_the_stage_drops_near_copies_beyond_two_bits(spark):
    rng = random.Random(5)
    w = [f"word{rng.randrange(900)}" for _ in range(200)]
    near = w[:100] + ["changed"] + w[101:]
    far = w[:20] + [f"x{i}" for i in range(180)]
    rows = [(1, " ".join(w)), (2, " ".join(near)), (3, " ".join(far))]
    assert (h.simhash(rows[0][1]) ^ h.simhash(rows[1][1])).bit_count() > 2
    got = corpus_pipeline.near_dedup(spark, h.frame(spark, rows), "")
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3]


def test_near_copies_repeated_ids_nulls_and_empty(spark):
    rows = [(5, "same words here now then again"), (5, "same words here now then again"), (None, "same words here now then again"), (2, "quite other text than that one")]
    got = simhash.keep_one_of_each(h.frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 2]
    assert simhash.keep_one_of_each(h.frame(spark, [])).count() == 0


def test_wide_fingerprints_and_their_blocks():
    rng = np.random.default_rng(3)
    wide = simhash.Wide(24, 16)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (1, 7, 300, 700)]
    prints = simhash.wide_fingerprints(sets, wide)
    for k in range(wide.words):
        own = simhash.wide_fingerprints(sets, simhash.Wide(64, k + 1))[:, k]
        assert (own == prints[:, k]).all()
    whole = [int.from_bytes(p.tobytes(), "little") for p in prints]
    assert simhash.blocks_of(prints, wide).tolist() == [[w >> 24 * b & 0xFFFFFF for b in range(16)] for w in whole]
    near = np.concatenate((sets[3][:650], rng.integers(0, 1 << 63, 50, np.uint64)))
    a, b = simhash.wide_fingerprints([sets[3], near], simhash.Wide())
    apart = sum(int(x).bit_count() for x in a ^ b)
    assert 0.08 < apart / 3072 < 0.18 and simhash.Wide().most == 768


def test_large_blocks_of_more_than_two_bits(spark):
    rng = random.Random(17)
    marks = {rng.getrandbits(62) for _ in range(30)}
    start = rng.getrandbits(62)
    marks |= {start ^ sum(1 << rng.randrange(62) for _ in range(k % 5)) for k in range(60)}
    df = spark.createDataFrame([(m,) for m in sorted(marks)], "fp long")
    from tissuemill.llm.components import components

    got = {r["node"]: r["component"] for r in components(simhash.links(df, 3, 5, block_rows=3)).collect()}
    want = h.components([(m, m) for m in sorted(marks)], 3)
    assert [got.get(m, m) for m in sorted(marks)] == want
