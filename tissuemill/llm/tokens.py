"""Token counts by section: whole documents are encoded once, token spans are joined to sections by offset."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissuemill.llm.common import text_buffer

#: Fixed value: the published split pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of the vocabulary file that may be broadcast.
MOST_RANKS = 64 << 20
_made: dict = {}


def _encoder(raw: bytes, pattern: str):
    """The encoder of a rank file and the bytes of each token; made once in a worker."""
    import tiktoken

    key = (hash(raw), pattern)
    if key not in _made:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _made[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _made[key]


def attributed(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a boundary.

    ``sections``: ascending starts of the sections, which cover 0..size; starts and ends: the tokens' spans. A crossing
    token goes to the section of its first unit (rule first), of its last (last), or where most of it lies (most; first of equals).
    """
    low = np.searchsorted(sections, starts, "right") - 1
    high = np.searchsorted(sections, ends - 1, "right") - 1
    crossing = np.flatnonzero(low != high)
    owner = high.copy() if rule == "last" else low.copy()
    if rule == "most":
        bounds = np.append(sections, size)
        for t in crossing.tolist():
            within = range(low[t], high[t] + 1)
            owner[t] = max(within, key=lambda s: (min(ends[t], bounds[s + 1]) - max(starts[t], bounds[s]), -s))
    return np.bincount(owner, minlength=len(sections)), len(crossing)


def section_counts(docs: DataFrame, vocabulary: str, fields: Sequence[str] = ("text",), by: str = "lines", rule: str = "first", pattern: str = PATTERN) -> DataFrame:
    """Of every row of ``docs``: doc_id, n_tokens, n_crossing, sections (array of first_char, end_char, n_tokens).

    The fields are joined by a line feed and encoded once, as one text; ``by``: sections are its lines (each with its
    line feed) or its fields (each but the last with the joining one). Token spans come from the bytes of the tokens; a
    crossing token is allotted by ``rule`` (see ``attributed``), so section counts always add up to n_tokens. Spans of
    sections are in code points. Null fields are empty; an empty text has no tokens and one empty section. Strings of
    special tokens are ordinary text. Rows that repeat a doc_id keep a row each; doc_ids may be null and of any type. A text
    of any length is encoded whole. An empty table gives no rows. ``vocabulary``: path of a rank
    file; it is read by Spark and broadcast after a check of its size.
    """
    if rule not in ("first", "last", "most") or by not in ("lines", "fields"):
        raise ValueError("rule is first, last or most; by is lines or fields")
    spark = docs.sparkSession
    file = spark.read.format("binaryFile").load(vocabulary)
    if file.agg(F.sum("length")).first()[0] > MOST_RANKS:
        raise ValueError(f"the vocabulary is over {MOST_RANKS} bytes")
    shared = spark.sparkContext.broadcast(bytes(file.select("content").first()[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = _encoder(shared.value, pattern)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ends_of_fields = batch.column(2)
            totals, crossings, per, flat = [], [], [], []
            for k in range(len(offsets) - 1):
                raw = data[offsets[k] : offsets[k + 1]]
                tokens = np.array(encoder.encode_ordinary(raw.tobytes().decode("utf-8", "replace")), np.int64)
                ends = np.cumsum(sizes[tokens])
                if by == "lines":
                    cuts = np.flatnonzero(raw[:-1] == 10) + 1
                else:
                    cuts = np.array(ends_of_fields[k].as_py()[:-1], np.int64)
                sections = np.concatenate(([0], cuts))
                n, crossing = attributed(ends - sizes[tokens], ends, sections, len(raw), rule)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                totals.append(len(tokens))
                crossings.append(crossing)
                per.append(len(sections))
                flat.append((chars[sections], chars[np.append(cuts, len(raw))], n))
            cols = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*flat, strict=True)] if flat else [pa.array([], pa.int64())] * 3
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))).astype(np.int32)), pa.StructArray.from_arrays(cols, ["first_char", "end_char", "n_tokens"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(crossings, pa.int64()), lists], ["doc_id", "n_tokens", "n_crossing", "sections"])

    texts = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    joined = F.concat_ws("\n", *texts)
    sizes = [F.octet_length(t) + (1 if i + 1 < len(texts) else 0) for i, t in enumerate(texts)]
    ends = F.array(*[sum(sizes[1 : i + 1], sizes[0]).cast("long") for i in range(len(sizes))])
    return docs.select("doc_id", joined.alias("text"), ends.alias("ends")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_crossing long, sections array<struct<first_char:long,end_char:long,n_tokens:long>>")
