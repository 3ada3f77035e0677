"""Language identification by rank-order profiles: out-of-place distance of a text's most frequent n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissuemill.llm.common import filtered, groups_of_rows, text_buffer

#: Languages that may be learned: profiles of so many go to the driver and to each task.
MOST_LANGUAGES = 1000
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> list[np.ndarray]:
    """The letter n-grams (1 to 3) of each text as numbers.

    Texts are lower-cased; what isn't a letter parts words; words are bounded by one space.
    """
    lower = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in lower])))
    c = np.where(_letters()[points], points, np.uint32(SPACE))
    dark = c != SPACE
    keep = dark.copy()
    keep[1:] |= dark[:-1]
    keep[bounds[:-1]] = True
    c, dark = c[keep].astype(np.uint64), dark[keep]
    bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
    pair = (c[:-1] << np.uint64(21)) | c[1:]
    triple = (pair[:-1] << np.uint64(21)) | c[2:]
    two, three = dark[1:] | dark[:-1], dark[1:-1]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out.append(np.concatenate((c[a:b][dark[a:b]], pair[a : b - 1][two[a : b - 1]], triple[a : max(a, b - 2)][three[a : max(a, b - 2)]])))
    return out


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = np.sort(found)
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.zeros(0, np.int64)
    return found[first], np.diff(np.concatenate((first, [len(found)])))


def ranked(found: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, most frequent first, ties by number."""
    names, counts = counted(found)
    if len(names) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        names, counts = names[counts >= least], counts[counts >= least]
    return names[np.argsort(-counts, kind="stable")][:top]


def _rows(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    data, offsets = text_buffer(column)
    for i, j in groups_of_rows(offsets):
        yield i, [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist(), strict=True)]


def profiles(labelled: DataFrame, top: int = 300) -> dict[str, list[int]]:
    """For each lang of ``labelled`` (text, lang), its ``top`` n-grams over all its texts, most frequent first.

    Counts are made in each task, summed by Spark; only the profiles come to the driver. Rows with a null text or lang teach
    nothing; a lang without any letter has no profile.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for i, texts in _rows(batch.column(0)):
                by: dict[str, list[np.ndarray]] = {}
                for lang, found in zip(langs[i : i + len(texts)], grams(texts), strict=True):
                    by.setdefault(lang, []).append(found)
                for lang, parts in by.items():
                    names, counts = counted(np.concatenate(parts))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    counts = labelled.where("text is not null and lang is not null").select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = total.withColumn("nth", nth).where(F.col("nth") <= top).orderBy("lang", "nth").limit(MOST_LANGUAGES * top + 1).collect()
    out: dict[str, list[int]] = {}
    for row in best:
        out.setdefault(row["lang"], []).append(row["gram"])
    if len(best) > MOST_LANGUAGES * top or len(out) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return out


class Judge:
    """Out-of-place distances to learned profiles."""

    def __init__(self, learned: dict[str, list[int]], top: int = 300):
        self.top, self.langs = top, sorted(learned)
        self.names = np.array(sorted({g for x in learned.values() for g in x}), np.uint64)
        self.ranks = np.full((len(self.names) + 1, len(self.langs)), -1, np.int32)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.names, np.array(learned[lang], np.uint64)), k] = np.arange(len(learned[lang]))

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for found in grams(texts):
            own = ranked(found, self.top)
            if not len(own) or not self.langs:
                out.append(("und", 0.0))
                continue
            at = np.searchsorted(self.names, own)
            at[self.names[np.minimum(at, len(self.names) - 1)] != own] = len(self.names)  # the last row of ranks: in no profile
            there = self.ranks[at]
            away = np.where(there < 0, self.top, np.abs(there - np.arange(len(own), dtype=np.int32)[:, None])).sum(axis=0)
            best = int(np.argmin(away))
            out.append((self.langs[best], float(1 - away[best] / (self.top * len(own)))))
        return out


def _learned(docs: DataFrame, top: int) -> Judge:
    taught = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    return Judge(profiles(docs.where(taught), top), top)


def identify(docs: DataFrame, top: int = 300) -> DataFrame:
    """Of every row of ``docs``: doc_id, held_out, lang_pred, score.

    Profiles are learned from all rows with a text and a lang whose crc32(doc_id) mod 4 isn't 2; the other rows are held out.
    A prediction uses the whole text alone; score is 1 less the distance as a part of the largest possible one. ``und``
    (score 0): null texts, texts without a letter, nothing learned. Equal distances: the first lang in order. Rows
    with a null doc_id aren't held out and teach nothing; doc_ids may be of any type, and rows that repeat one keep a row each. A very
    long text is profiled whole. An empty table gives no rows.
    """
    judge = _learned(docs, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [x for _, texts in _rows(batch.column(2)) for x in judge(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in said], pa.string()), pa.array([x[1] for x in said], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, top: int = 300, least: float = 1 / 3) -> DataFrame:
    """The rows of ``docs`` written in a learned language; where lang is null it is set to the predicted one.

    Profiles are learned as in ``identify``. A row goes if its text is null or has no letter, or if its nearest profile scores
    under ``least``, which text in a language or script without a profile does. All other columns and stated langs
    stay as they are. Where nothing can be learned, rows with a letter stay, and null langs stay null.
    """
    judge, at, lang = _learned(docs, top), docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if judge.langs:
                said = [x for _, texts in _rows(batch.column(at)) for x in judge(texts)]
            else:
                said = [(None, float(len(g) > 0)) for _, texts in _rows(batch.column(at)) for g in grams(texts)]
            stated = batch.column(lang)
            filled = pa.array([a if a is not None else b for a, (b, _) in zip(stated.to_pylist(), said, strict=True)], stated.type)
            good = pa.array([score >= least for _, score in said], pa.bool_())
            yield batch.set_column(lang, batch.schema.field(lang), filled).filter(good)

    return filtered(docs, run)
