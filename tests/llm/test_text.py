import hashlib
import os
import random

import pytest

from tests.llm import helpers as h
from tissuemill.llm import decontaminate, langid, licenses, mixing, order_minhash, tokens, warc

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EN, DE = "the and with that this from have which would there", "und der die das nicht mit sich auch werden eine"


def test_language_id_held_out(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice((EN, DE)[i % 2].split()) for _ in range(30)), ("en", "de")[i % 2], "s", 0) for i in range(80)]
    rows += [(100, None, "en", "s", 0), (101, "123 !?", None, "s", 0), (102, "", None, "s", 0), (None, EN, "en", "s", 0)]
    got = {r["doc_id"]: r for r in langid.identify(h.frame(spark, rows)).collect()}
    import zlib

    for i in range(80):
        assert got[i]["lang_pred"] == ("en", "de")[i % 2] and 0 < got[i]["score"] <= 1
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102)) and got[None]["lang_pred"] == "en"
    kept = langid.keep_identified(h.frame(spark, rows))
    assert kept.count() == 81 and kept.columns == h.frame(spark, rows).columns
    assert langid.identify(h.frame(spark, [])).count() == 0
    assert langid.identify(h.frame(spark, [(1, "some text", None, "s", 0)])).first()["lang_pred"] == "und"


def test_language_profile_ranks_are_counts(spark):
    docs = h.frame(spark, [(1, "aab ab", "x", "s", 0)])
    profile = langid.profiles(docs)["x"]
    assert profile[0] == ord("a") and len(profile) == len(set(profile))
    whole = {"a": 3, "b": 2, " a": 2, "ab": 2, "b ": 2, "aa": 1}
    number = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    ranks = {p: i for i, p in enumerate(profile)}
    assert all(ranks[number(a)] < ranks[number(b)] for a in whole for b in whole if whole[a] > whole[b])


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(3)
    letters = "abcdefghij"
    text = lambda n: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))
    items = [(i, text(40)) for i in range(12)] + [(90, None), (91, "short"), (92, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for i in range(40):
        body = text(150)
        if i % 2:
            item = i % 12
            leak = items[item][1]
            if i % 3 == 0:
                leak = leak.upper().replace(" ", " - ")
            if i % 5 == 0:
                k = len(leak) // 2
                leak = leak[:k] + "zz" + leak[k + 1 :]
            body = body[:300] + " " + leak + " " + body[300:]
            want.add((i, item))
        rows.append((i, body))
    rows += [(200, None), (201, ""), (202, items[5][1][10:140])]
    want.add((202, 5))
    got = decontaminate.leaks(h.frame(spark, rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    hit = next(r for r in got if r["doc_id"] == 1)
    assert rows[1][1].encode()[hit["first_byte"] : hit["end_byte"]].decode() == items[1][1]
    clean = decontaminate.without_leaks(h.frame(spark, rows), benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in want}
    assert decontaminate.leaks(h.frame(spark, rows), benchmark.limit(0)).count() == 0 and decontaminate.leaks(h.frame(spark, []), benchmark).count() == 0


def test_leaks_in_blocks_of_the_benchmark(spark, monkeypatch):
    items = [(i, f"number{i} " + " ".join(f"token{i}x{k}" for k in range(20))) for i in range(10)]
    docs = h.frame(spark, [(i, "before it " + t + " after it") for i, t in items])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    assert len(list(decontaminate._blocks(benchmark))) > 1
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()} == {(i, i) for i in range(10)}


def test_banded_alignment_is_edit_distance():
    rng = random.Random(7)
    for _ in range(60):
        p = bytes(rng.choice(b"abc") for _ in range(18))
        q = bytearray(p)
        for _ in range(rng.randrange(4)):
            q[rng.randrange(len(q))] = rng.choice(b"abc")
        r = bytes(rng.choice(b"abc") for _ in range(6)) + bytes(q) + bytes(rng.choice(b"abc") for _ in range(5))
        assert decontaminate.distances([p], [r])[0][0] == h.edit_distance_inside(p, r)


def test_mixing_keeps_rows_and_deviates_by_less_than_a_block(spark):
    rng = random.Random(5)
    rows = [(i, "t", "en", rng.choice(["a"] * 6 + ["b", "b", "c", None]), 1) for i in range(900)]
    docs = h.frame(spark, rows)
    weights = {"a": 5, "b": 3, "c": 2, mixing.NO_SOURCE: 1}
    got = mixing.mix(docs, weights, block_rows=4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(900)) and len({r["mix_position"] for r in got}) == 900
    slots = {}
    for r in got:
        slots.setdefault(r["mix_slot"], set()).add((r["source"], r["mix_block"]))
    assert all(len(v) == 1 for v in slots.values())
    seen = dict.fromkeys(weights, 0)
    last = max(r["mix_slot"] for r in got if r["mix_balanced"])
    assert last > 20
    for t in range(last + 1):
        source, block = next(iter(slots[t]))
        assert block == seen[source or mixing.NO_SOURCE]
        seen[source or mixing.NO_SOURCE] += 1
        assert all(abs(n - (t + 1) * weights[s] / 11) < 1 for s, n in seen.items())


def test_mixing_edges(spark):
    assert mixing.mix(h.frame(spark, [])).count() == 0
    rows = [(1, "t", "en", "a", 1)] * 3 + [(None, "t", "en", None, 1)]
    got = mixing.mix(h.frame(spark, rows).withColumnRenamed("n_chars", "mix_slot"))
    assert got.count() == 4 and got.columns[-4:] == ["mix_block", "mix_slot", "mix_position", "mix_balanced"] and len({r["mix_position"] for r in got.collect()}) == 4


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_section_counts(spark):
    texts = ["one line\n\nand  another\n", "ünïcode 漢字\nx", "", None, "\n", "word " * 3000]
    docs = h.frame(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in tokens.section_counts(docs, VOCABULARY).collect()}
    encoder, sizes = tokens._encoder(open(VOCABULARY, "rb").read(), tokens.PATTERN)
    for i, t in enumerate(texts):
        t = t or ""
        ids = encoder.encode_ordinary(t)
        lines = t.splitlines(keepends=True) or [""]
        assert got[i]["n_tokens"] == len(ids) == sum(s["n_tokens"] for s in got[i]["sections"])
        assert [t[s["first_char"] : s["end_char"]] for s in got[i]["sections"]] == lines
        at, counts, ends = 0, [0] * len(lines), [sum(len(x.encode()) for x in lines[: k + 1]) for k in range(len(lines))]
        for k in ids:
            counts[next(j for j, e in enumerate(ends) if at < e)] += 1
            at += int(sizes[k])
        assert [s["n_tokens"] for s in got[i]["sections"]] == counts


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_section_counts_by_field_and_rule(spark):
    docs = spark.createDataFrame([(1, "abc   ", "   def"), (2, None, "x")], "doc_id long, title string, body string")
    for rule in ("first", "last", "most"):
        got = tokens.section_counts(docs, VOCABULARY, ("title", "body"), "fields", rule).orderBy("doc_id").collect()
        assert all(len(r["sections"]) == 2 and sum(s["n_tokens"] for s in r["sections"]) == r["n_tokens"] for r in got)
        assert got[0]["sections"][1]["first_char"] == 7
    import numpy as np

    spans, sections = (np.array([0, 2, 6]), np.array([2, 6, 9])), np.array([0, 3])
    assert [tokens.attributed(*spans, sections, 9, r)[0].tolist() for r in ("first", "last", "most")] == [[2, 1], [1, 2], [1, 2]]


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 300_000
    rows = [(1, "http://a/ b\n", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", big), (9, "u", "<p>one</p>"), (10, "u", "é\r\n\r\nWARC/1.1 ")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(spark, str(tmp_path)).collect()}
    last = {}
    for i, _, t in rows:
        last[t or ""] = i
    want = {i: (len((t or "").encode()), h.sha1_base32((t or "").encode()), "response" if last[t or ""] == i else "revisit", None if last[t or ""] == i else last[t or ""]) for i, _, t in rows}
    assert got == want
    spark.createDataFrame([], pages.schema).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert warc.round_trip(spark, str(tmp_path / "none")).count() == 0


def test_warc_members_stand_alone_and_repeats(spark, tmp_path):
    rows = [(None, "u", "a"), (3, "u", "a"), (3, "v", "a"), (2, "u", "b" * 10)]
    written = warc.write_monolithic(warc.decided(spark.createDataFrame(rows, "page_id long, url string, html string"), 5), f"file://{tmp_path}/mono", roll=1)
    index = warc.normalise(written, f"file://{tmp_path}/members")
    import zlib

    for r in index.collect():
        with open(r["path"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            raw = zlib.decompress(f.read(r["length"]), 31)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and warc.fields_of(raw)[0]["WARC-Record-ID"] == r["record_id"]
    assert {r["record_type"] for r in index.collect()} == {"response"}  # payloads under 5 bytes
    sides = list(tmp_path.glob("members/*.index.jsonl"))
    assert sum(len(s.read_text().splitlines()) for s in sides) == 4


def test_order_minhash(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base = text(900)
    rows = [(i, text(rng.randrange(0, 700))) for i in range(30)] + [(40, base), (41, base), (42, base[:450] + "#" + base[450:]), (43, None), (44, ""), (45, "é漢"), (46, "a" * 500)]
    got = {r["doc_id"]: r for r in order_minhash.fingerprints(h.frame(spark, rows).repartition(3)).collect()}
    down = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(down):
        t, nxt = t or "", down[(k + 1) % len(down)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        same = sum(got[i]["fingerprint"][j : j + 4] == got[i]["edited_fingerprint"][j : j + 4] for j in range(0, 256, 4)) / 64
        assert got[i]["near_edited"] == same and got[i]["near_next"] == sum(got[i]["fingerprint"][j : j + 4] == got[down[(k + 1) % len(down)][0]]["fingerprint"][j : j + 4] for j in range(0, 256, 4)) / 64
    assert got[40]["fingerprint"] == got[41]["fingerprint"] and got[43]["fingerprint"] == got[44]["fingerprint"]
    assert got[42]["near_next"] > 0.8 and got[40]["near_next"] < 0.1
    one = order_minhash.fingerprints(h.frame(spark, [(1, "abcdef")])).first()
    assert one["near_next"] == 1 and order_minhash.fingerprints(h.frame(spark, [])).count() == 0
    assert order_minhash.fingerprints(h.frame(spark, [(1, "a"), (1, "b"), (None, "c")])).count() == 3


def test_order_minhash_hears_order():
    import numpy as np

    a = np.frombuffer("".join(f"{i:06d}" for i in range(200)).encode(), np.uint8).astype(np.uint64)
    half = len(a) // 2
    swapped = np.concatenate((a[half:], a[:half]))
    assert 0.2 < (order_minhash.signature(a) == order_minhash.signature(swapped)).mean() < 0.8  # a set of k-mers would stay near 1


def test_licence_rules(spark):
    s = licenses.SENTENCES
    bsd = "\n".join([s["bsd-grant"], "1. " + s["bsd-source"], "2. " + s["bsd-binary"], s["bsd-endorse"]]).replace("1. ", "").replace("2. ", "")
    rows = [
        (1, "Intro.\nReleased under the MIT License.\nMore text."), (2, "SPDX-License-Identifier: Apache-2.0\ncode"), (3, "intro. " + bsd),
        (4, bsd.replace(s["bsd-endorse"], "")), (5, s["bsd-binary"] + " " + s["bsd-source"]), (6, None), (7, ""), (8, "Released under the MIT licence."),
        (9, "LICENSED UNDER cc by-nc   4.0. Released under the MIT License."), (10, s["gpl3-notice"] + "\n\n" + s["gpl-no-warranty"]),
    ]
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(h.frame(spark, rows)).collect()}
    assert got == {(1, "MIT"), (2, "Apache-2.0"), (3, "BSD-3-Clause"), (4, "BSD-2-Clause"), (9, "CC-BY-NC-4.0"), (9, "MIT"), (10, "GPL-3.0-or-later")}
    assert licenses.scan(h.frame(spark, [])).count() == 0
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {tuple(r) for r in con.execute(licenses.oracle()).fetchall()}
    assert {tuple(r) for r in licenses.scan(h.frame(spark, rows)).collect()} == want


def test_licence_rows_are_documents(spark):
    """Two rows of one doc_id, or of none, state together what neither states alone."""
    s = licenses.SENTENCES
    rows = [(1, s["mit-grant"]), (1, s["mit-notice"]), (None, s["mit-grant"]), (None, s["mit-notice"]), (None, s["mit-short"]), (None, s["mit-short"])]
    assert [tuple(r)[:2] for r in licenses.scan(h.frame(spark, rows)).collect()] == [(None, "MIT"), (None, "MIT")]


def test_short_items_text_ids_and_exact_starts(spark):
    benchmark = spark.createDataFrame([("x", "beta gam x"), ("y", "hello"), ("z", "the quick brown fox jumps over the lazy dog and runs away")], "item_id string, text string")
    texts = ["alpha Beta  gam, X tail", "xbeta gam x", "hello", "othello hello2", "before THE quickly brown fox jumps over the lazy dog and runs away etc", "words. the quick brown fox jumpsover the lazzy dog and runs away!", ""]
    docs = h.frame(spark, list(enumerate(texts)))
    got = {(r["doc_id"], r["item_id"], texts[r["doc_id"]].encode()[r["first_byte"] : r["end_byte"]].decode()) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(0, "x", "Beta  gam, X"), (2, "y", "hello"), (4, "z", texts[4][7:-4]), (5, "z", texts[5][7:-1])}
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, benchmark).collect()} == {1, 3, 6}


def test_mixing_of_many_parts(spark):
    rows = [(i, "t", "en", "ab"[i % 2], 1) for i in range(40)]
    got = mixing.mix(h.frame(spark, rows), {"a": 20_001, "b": 1}, block_rows=2).collect()
    assert len({r["mix_position"] for r in got}) == 40


def test_language_stage_keeps_learned_languages(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice((EN, DE)[i % 2].split()) for _ in range(30)), ("en", "de")[i % 2], "s", 0) for i in range(60)]
    rows += [(100, "это другой язык и другое письмо", None, "s", 0), (101, "und der die das nicht auch werden", None, "s", 0), (102, "1 2", "en", "s", 0)]
    kept = {r["doc_id"]: r["lang"] for r in langid.keep_identified(h.frame(spark, rows)).collect()}
    assert kept == {**{i: ("en", "de")[i % 2] for i in range(60)}, 101: "de"}
    assert langid.keep_identified(h.frame(spark, [(1, "some text", None, "s", 0), (2, "12", None, "s", 0)])).count() == 1


def test_language_scores_are_out_of_place_distances(spark):
    """Scores and languages against a plain version over n-grams as strings."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice((EN, DE)[i % 2].split()) for _ in range(12)), ("en", "de")[i % 2], "s", 0) for i in range(24)]
    import collections
    import zlib

    def counts(text):
        out = collections.Counter()
        for w in text.split():
            out.update(w)
        padded = " " + " ".join(text.split()) + " "
        for n in (2, 3):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1) if n == 2 or padded[i + 1] != " ")
        return out

    def order(c):
        return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], sum(ord(a) << (21 * (len(x[0]) - 1 - i)) for i, a in enumerate(x[0]))))][:300]

    learned = {}
    for i, t, lang, *_ in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            learned[lang] = learned.get(lang, collections.Counter()) + counts(t)
    ranks = {lang: {g: k for k, g in enumerate(order(c))} for lang, c in learned.items()}
    for r in langid.identify(h.frame(spark, rows)).collect():
        own = order(counts(rows[r["doc_id"]][1]))
        away = {lang: sum(abs(of[g] - k) if g in of else 300 for k, g in enumerate(own)) for lang, of in ranks.items()}
        best = min(sorted(away), key=away.get)
        assert r["lang_pred"] == best and abs(r["score"] - (1 - away[best] / (300 * len(own)))) < 1e-12


def test_ids_of_any_type(spark, tmp_path):
    """Text ids, repeated and null ones: a row for each row, and the id as it was."""
    docs = spark.createDataFrame([("a/1", EN, "en", "s", 0), ("a/1", EN, "en", "s", 0), ("b", DE, "de", "s", 0), (None, None, None, None, None)], "doc_id string, text string, lang string, source string, n_chars long")
    want = [None, "a/1", "a/1", "b"]
    key = lambda x: (x is not None, x)
    for got in (langid.identify(docs), tokens.section_counts(docs, VOCABULARY), order_minhash.fingerprints(docs)):
        assert sorted((r["doc_id"] for r in got.collect()), key=key) == want
    pages = spark.createDataFrame([("p one", "u", "<a>"), ("q/2", None, "<a>"), ("none", "v", "é"), (None, "w", None)], "page_id string, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    rows = {r["page_id"]: r for r in warc.round_trip(spark, str(tmp_path)).collect()}
    assert set(rows) == {"p one", "q/2", "none", None} and rows["p one"]["refers_to"] == "q/2" and rows["q/2"]["record_type"] == "response"
    assert rows["none"]["payload_bytes"] == 2 and rows[None]["payload_bytes"] == 0


def test_leaks_keep_benchmark_rows_apart(spark, monkeypatch):
    """Two rows with one item_id: reported each for itself, in one block or in many."""
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8))) for _ in range(n))
    one, two = text(30), text(60)
    docs = h.frame(spark, [(1, f"{text(20)} {one} {text(20)} {two} {text(5)}"), (1, two), (2, text(200))])
    benchmark = spark.createDataFrame([(7, one), (7, two), (7, two), (8, None)], "item_id long, text string")
    seen = []
    for size in (decontaminate.BLOCK_BYTES, 150):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        seen.append(sorted(tuple(r) for r in decontaminate.leaks(docs, benchmark).collect()))
    assert seen[0] == seen[1] and [r[:2] for r in seen[0]] == [(1, 7)] * 5
    assert len({r[5] for r in seen[0]}) == 2  # the passages of one text, not of both


def test_long_texts_of_text_operators(spark):
    """Texts of over 1 MiB go whole through every operator of this file; empty tables give nothing."""
    rng = random.Random(9)
    long = " ".join(rng.choice(EN.split()) for _ in range(260_000))
    docs = h.frame(spark, [(1, long), (2, long[: 1 << 20]), (3, EN)])
    assert len(long) > 1 << 20 and {r["lang_pred"] for r in langid.identify(docs).collect()} == {"en"}
    counts = {r["doc_id"]: r for r in tokens.section_counts(docs, VOCABULARY).collect()}
    assert counts[1]["n_tokens"] == sum(s["n_tokens"] for s in counts[1]["sections"]) > 200_000
    marks = {r["doc_id"]: r for r in order_minhash.fingerprints(docs).collect()}
    assert marks[1]["n_chars"] == len(long) and 0 <= marks[2]["near_next"] <= 1
    assert decontaminate.leaks(docs, spark.createDataFrame([(5, long[-500:])], "item_id long, text string")).where("doc_id = 1").count() == 1
    assert licenses.scan(docs).count() == 0 and mixing.mix(docs).count() == 3
    none = h.frame(spark, [])
    assert tokens.section_counts(none, VOCABULARY).count() == 0 and order_minhash.fingerprints(none).count() == 0


def test_leaks_equal_brute_force(spark):
    """Documents with passages at, below and above the budget of edits: what is found is what plain edit distances say."""
    import re

    rng = random.Random(21)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))

    def edited(s, n):
        for _ in range(n):
            k = rng.randrange(len(s))
            s = rng.choice((s[:k] + rng.choice("klmn") + s[k + 1 :], s[:k] + s[k + 1 :], s[:k] + rng.choice("klmn") + s[k:]))
        return s

    items = [(0, text(9)), (1, text(22)), (2, text(45)), (3, text(5)), (3, text(30)), (4, "zz " + text(17))]
    docs = []
    for i in range(14):
        part = rng.choice(items)[1]
        a = rng.randrange(max(1, len(part) - 60))
        docs.append((i, f"{text(15)}, {edited(part[a:], rng.randrange(9)).upper() if i % 3 else part[a:]}! {text(15)}"))
    plain = lambda s: re.sub("[^a-z0-9]+", " ", s.lower()).strip()
    want = []
    for d, body in docs:
        for item, s in items:
            whole = plain(s)
            cuts = [0] if len(whole) <= 144 else [*range(0, len(whole) - 96, 48), len(whole) - 96]
            parts = [whole if len(cuts) == 1 else whole[a : a + 96] for a in cuts]
            least = [h.edit_distance_inside(p, f" {plain(body)} ") for p in parts]
            hit = [e for e, p in zip(least, parts, strict=True) if e <= min(int(len(p) * 0.06), (len(p) - 12) // 12)]
            if hit:
                want.append((d, item, len(hit), len(parts), sum(hit)))
    got = decontaminate.leaks(h.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["passages_hit"], r["passages"], r["edits"]) for r in got) == sorted(want)
    assert 3 < len({w[0] for w in want}) < len(docs)


@pytest.mark.parametrize("text", ["", "abc", "abcabcabcabcabc" * 3, "the quick brown fox jumps over the lazy dog, the quick brown fox", "é日本" * 9])
def test_signature_is_the_two_least_occurrences_in_text_order(text):
    import numpy as np

    om, mask = order_minhash, (1 << 64) - 1
    stirred = lambda x: int(om.stirred(np.array([x & mask], np.uint64))[0])
    points = [ord(c) for c in text]
    points += [0x110000] * (om.K - len(points)) if points else []
    kmers = [stirred(sum(p * int(w) for p, w in zip(points[i : i + om.K], om.WEIGHTS, strict=True))) for i in range(len(points) - om.K + 1)]
    seen, base = {}, []
    for k in kmers:
        base.append(stirred(k + seen.get(k, 0) * 0x9E3779B97F4A7C15) >> 32)
        seen[k] = seen.get(k, 0) + 1
    want = []
    for part in range(om.PARTS):
        ranked = sorted(range(len(base)), key=lambda i: (((base[i] ^ int(om.FLIPS[part])) * int(om.FACTORS[part])) % (1 << 32), i))
        low, high = (min(ranked[:2]), max(ranked[:2])) if len(ranked) > 1 else (0, 0)
        want.append(stirred(kmers[low] * int(om.WEIGHTS[0]) + stirred(kmers[high] + int(om.SALTS[part]))) >> 48 if kmers else 0)
    assert om.signature(np.array([ord(c) for c in text], np.uint64)).tolist() == want
