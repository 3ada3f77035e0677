"""WARC archives: written as monolithic gzip, normalised to one member a record with an offset index, read back.

Archives lie in shared storage and are opened with Arrow's file systems. A file's name is new for each attempt; which
files count is told by the table of written files, which Spark commits, so that lost and repeated tasks do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tissuemill.llm.common import materialise, shared_dir, table

#: Payload bytes after which a task starts a new archive.
ROLL = 64 << 20
READ = 1 << 18
DATE = "2024-01-01T00:00:00Z"  # written into every record, so that equal input gives equal archives
INDEX = "path string, offset long, length long, record_type string, record_id string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | str | None) -> str:
    """A page_id in a URN: numbers as they are, others quoted after ``=``."""
    return "none" if page_id is None else str(page_id) if isinstance(page_id, int) else "=" + quote(str(page_id), safe="")


def record(page_id: int | str | None, url: str | None, payload: bytes, refers_to: int | str | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone; both tell the full payload's size and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = _name(page_id)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else f'urn:page:{name}'}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        fields += [f"WARC-Refers-To: <urn:page:{_name(refers_to)}>"] if refers_to is not None else []
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields_of(raw: bytes) -> tuple[dict[str, str], int]:
    """The header fields of a record, and where its block begins."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x), end + 4


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, one at a time, of an inflated stream; the stream is held no further than the record that is read."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        while (end := held.find(b"\r\n\r\n")) >= 0:
            fields, begin = fields_of(bytes(held[: end + 4]))
            size = begin + int(fields["Content-Length"]) + 4
            if len(held) < size:
                break
            yield bytes(held[:size])
            del held[:size]
    if held.strip():
        raise ValueError("the archive ends within a record")


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or many, inflated as they are read."""
    inflate = zlib.decompressobj(31)
    while chunk := source.read(READ):
        while chunk:
            yield inflate.decompress(chunk)
            chunk = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                inflate = zlib.decompressobj(31)


def member(raw: bytes, level: int = 4) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


#: Names that Hadoop gives to stores which Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def _open(path: str):
    scheme, colon, rest = path.partition("://")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


def decided(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) of every page: of equal payloads the largest page_id is the response.

    Null html is an empty payload. Payloads under ``least_bytes`` are all responses, and so are rows that repeat the
    response's page_id. Rows with a null page_id revisit the others, or are responses where all are null.
    Payloads are compared by SHA-256; copies are counted before the shuffle, and texts are dealt out by page.
    """
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    base = base.withColumn("same", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    marks = base.where(F.octet_length("payload") >= least_bytes).select("page_id", "same")
    first = marks.groupBy("same").agg(F.max("page_id").alias("keep"))
    later = marks.join(first, "same").where("keep is not null and (page_id is null or page_id <> keep)").distinct()
    later = later.select(F.col("page_id").alias("id"), F.col("same").alias("as"), "keep")
    both = base.join(later, base["page_id"].eqNullSafe(later["id"]) & (base["same"] == later["as"]), "left")
    return both.select("page_id", "url", F.col("payload"), F.col("keep").alias("refers_to"), F.col("keep").isNotNull().alias("revisit"))


def write_monolithic(rows: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Write records as archives of one gzip stream each; the table (path, records) of the files written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = deflate = None
        size = n = 0

        def close() -> pa.RecordBatch:
            out.write(deflate.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(5)), strict=True):
                page_id, url, payload, refers_to, revisit = (x.as_py() for x in row)
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, name = _open(path)
                    store.create_dir(name.rpartition("/")[0])
                    out, deflate, size, n = store.open_output_stream(name, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                raw = record(page_id, url, payload.encode(), refers_to, revisit)
                out.write(deflate.compress(raw))
                size, n = size + len(raw), n + 1
                if size >= roll:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return materialise(rows.mapInArrow(run, "path string, records long"))


def normalise(files: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Rewrite each archive of ``files`` (path) with every record as its own gzip member; the index of the new archives.

    The old file is inflated once, as a stream, whatever members it has; a record is held at a time. Beside each new
    archive lies its index, a line of JSON for each record: offset, length, type and id; the table has the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for old in batch.column(0).to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                (source, here), (store, name) = _open(old), _open(path)
                store.create_dir(name.rpartition("/")[0])
                rows: list[tuple] = []
                offset = 0
                with source.open_input_stream(here, compression=None) as old_file, store.open_output_stream(name, compression=None) as new, store.open_output_stream(name.replace(".warc.gz", ".index.jsonl"), compression=None) as side:
                    for raw in split_records(inflated(old_file)):
                        fields, _ = fields_of(raw)
                        new.write(packed := member(raw, level))
                        rows.append((path, offset, len(packed), fields["WARC-Type"], fields["WARC-Record-ID"]))
                        side.write((json.dumps(dict(zip(("offset", "length", "type", "id"), rows[-1][1:], strict=True))) + "\n").encode())
                        offset += len(packed)
                        if len(rows) == 5000:
                            yield _indexed(rows)
                            rows = []
                if rows:
                    yield _indexed(rows)

    n = max(1, files.count())  # as many tasks as archives, dealt by a hash of the path: without a number, few rows would be put together into one task
    return materialise(files.select("path").repartition(n, "path").mapInArrow(run, INDEX))


def _indexed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in INDEX.split(", ")])


def _page(urn: str | None) -> str | None:
    """The page_id of a URN, as text."""
    found = (urn or "<urn:page:none>")[len("<urn:page:") : -1]
    return None if found == "none" else unquote(found[1:]) if found.startswith("=") else found


def read_records(index: DataFrame, ids: str = "long") -> DataFrame:
    """Read every record of an index by its offset: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's payload is digested anew and must match its header. ``ids``: the type of page_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if path != at:
                    if file is not None:
                        file.close()
                    store, name = _open(path)
                    at, file = path, store.open_input_file(name)
                file.seek(offset)
                raw = zlib.decompress(file.read(length), 31)
                fields, begin = fields_of(raw)
                head, _, payload = raw[begin : begin + int(fields["Content-Length"])].partition(b"\r\n\r\n")
                size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
                said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != said):
                    raise ValueError(f"{path} at {offset}: the payload doesn't match its header")
                rows.append((_page(fields["WARC-Record-ID"]), size, said, fields["WARC-Type"], _page(fields.get("WARC-Refers-To"))))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if file is not None:
            file.close()

    read = index.select("path", "offset", "length").mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return read.withColumns({c: F.col(c).cast(ids) for c in ("page_id", "refers_to")})


def round_trip(spark: SparkSession, sf_dir: str, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives below ``folder``, normalise them, and read all records back. Empty tables give no rows.

    Very long payloads are written and read whole, one at a time. page_ids may be of any type; rows that repeat one give records of one
    id, and so do rows without one.
    """
    folder, pages = folder or shared_dir(spark), table(spark, sf_dir, "pages")
    written = write_monolithic(decided(pages, least_bytes), f"{folder}/monolithic")
    return read_records(normalise(written, f"{folder}/members"), pages.schema["page_id"].dataType.simpleString())
