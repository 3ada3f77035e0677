import random

import numpy as np

from tests.llm import helpers as h
from tissuemill.llm import decontaminate


def test_normalised_is_casefold_with_origins():
    rng = random.Random(8)
    letters = "aZ9 -éÉßẞİıΣςЖжKÅȺⱥŉ字𐐀𐐨"
    for _ in range(200):
        rows = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(4)]
        raw = [t.encode() for t in rows]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        text, bounds, origin = decontaminate.normalised(data, offsets)
        for i, t in enumerate(rows):
            got = text[bounds[i] : bounds[i + 1]].tobytes().decode()
            assert got.split() == "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.casefold()).split()
            own = origin[bounds[i] : bounds[i + 1]]
            assert (np.diff(own) >= 0).all() and (own >= offsets[i]).all() and (own < offsets[i + 1]).all()


def test_upper_cased_accented_passages_are_leaks(spark):
    rng = random.Random(6)
    text = lambda n: " ".join("".join(rng.choice("abcdeéàüöñжф") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    items = [(i, text(40)) for i in range(4)]
    rows = [(i, text(30) + " ẞİ " + items[i % 4][1].upper() + " " + text(30)) for i in range(8)] + [(20, text(100))]
    got = decontaminate.leaks(h.frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i % 4) for i in range(8)}
    for r in got:
        found = rows[r["doc_id"]][1].encode()[r["first_byte"] : r["end_byte"]].decode()
        assert found == items[r["item_id"]][1].upper() and r["edits"] == 0
