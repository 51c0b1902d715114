"""WARC archives: write pages as records, read them back sequentially.

One gzip member per record.  Each write task streams its rows to a file of its
own in the shared folder and returns the file's name once it is closed; only
files named that way are read, so what a lost or repeated task left behind does
not count.  The reader decompresses incrementally, member by member, frames the
block by Content-Length and verifies block and payload digests.

Pages with equal payloads are written once: the one with the largest page_id is
a ``response``, the others are ``revisit`` records without payload that name it.

Defined results: a null html is an empty payload; a row with a null page_id is
a revisit of the payload's largest id, or a response where no row of that
payload has an id; repeated rows of the largest id are all responses; a null
url is written as ``urn:x-page:unknown``; an empty table gives no archives and
no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import same_key, scratch_path, stage

MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 16
#: A header block longer than this is taken as damage.
MAX_HEADER = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def _record_id(page: int | None, fresh: str) -> str:
    return f"<urn:x-page:{page}>" if page is not None else f"<urn:x-page:none:{fresh}>"


def page_member(page: int | None, url: str | None, payload: bytes, refers_to: int | None, fresh: str) -> bytes:
    revisit = refers_to is not None
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page, fresh)),
               ("WARC-Date", DATE),
               ("WARC-Target-URI", urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "urn:x-page:unknown"),
               ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
               ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, ""))]
    return _member(headers, block)


def records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an archive in order; ValueError on anything cut short or not as declared."""
    pending = b""
    while True:
        pending = pending or stream.read(CHUNK)
        if not pending:
            return
        z, buffer, head, need = zlib.decompressobj(31), bytearray(), None, None
        while not z.eof:
            if not pending and not (pending := stream.read(CHUNK)):
                raise ValueError("archive ends inside a record")
            buffer += z.decompress(pending)
            pending = z.unused_data
            if head is None and (end := buffer.find(b"\r\n\r\n")) >= 0:
                lines = bytes(buffer[:end]).decode().split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("a record does not start with its version")
                head = dict(line.split(": ", 1) for line in lines[1:])
                need = end + 4 + int(head["Content-Length"]) + 4
                start = end + 4
            elif head is None and len(buffer) > MAX_HEADER:
                raise ValueError("record header too long")
            if need is not None and len(buffer) > need:
                raise ValueError("record longer than its Content-Length")
        if head is None or len(buffer) != need or buffer[-4:] != b"\r\n\r\n":
            raise ValueError("record shorter than its Content-Length")
        block = bytes(buffer[start:-4])
        if (said := head.get("WARC-Block-Digest")) and said != f"sha1:{digest(block)}":
            raise ValueError(f"block digest of {head.get('WARC-Record-ID')} differs")
        yield Record(head, block)


def payload_of(record: Record) -> bytes:
    """The HTTP body of a response, verified against its payload digest."""
    payload = record.block.partition(b"\r\n\r\n")[2]
    if (said := record.headers.get("WARC-Payload-Digest")) and said != f"sha1:{digest(payload)}":
        raise ValueError(f"payload digest of {record.headers.get('WARC-Record-ID')} differs")
    return payload


def assign_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses.

    The keeper of each payload comes from an aggregate with a map-side step;
    the join back is a plain equi-join, whose hot digests AQE splits.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", html.alias("html")).withColumn("_d", F.sha2("html", 256))
    keep = (pages.select("page_id", F.sha2(html, 256).alias("_k")).groupBy("_k")
            .agg(F.max("page_id").alias("_keeper")))
    other = (F.octet_length("html") >= min_bytes) & F.col("_keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keeper"))
    return p.join(keep, same_key(F.col("_d"), F.col("_k"))).select(
        "page_id", "url", "html", F.when(other, F.col("_keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages; returns the manifest (path, n_records)."""
    root = scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pafs.FileSystem.from_uri(root)
        ctx = TaskContext.get()
        path, n, out = f"{folder}/part-{ctx.partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, None
        for b in batches:
            for page, url, html, refers_to in zip(*[b.column(i) for i in range(4)]):
                if out is None:
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(path)
                    out.write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                       ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n"))
                out.write(page_member(page.as_py(), url.as_py(), html.as_py(), refers_to.as_py(), f"{ctx.partitionId()}-{n}"))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": pa.array([path]), "n_records": pa.array([n], pa.int64())})
    return stage(assign_types(pages, min_bytes).mapInArrow(run, "path string, n_records long"), "warc-manifest")


def read_archives(manifest: DataFrame, root: str, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_digest, refers_to, payload_bytes, payload) of all listed archives.

    One task reads an archive from front to back.  ``payload_bytes`` and
    ``payload`` of a revisit are null here; ``resolve`` fills in the length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(root)
        for b in batches:
            for path, said in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, size, n = [], 0, 0
                with store.open_input_stream(path) as stream:
                    for r in records(stream):
                        if r.headers["WARC-Type"] not in ("response", "revisit"):
                            continue
                        n += 1
                        rows.append(_row(r, with_payload))
                        size += len(r.block)
                        if size > 1 << 24 or len(rows) >= 5000:
                            yield _batch(rows)
                            rows, size = [], 0
                if n != said:
                    raise ValueError(f"{path} holds {n} records instead of {said}")
                if rows:
                    yield _batch(rows)
    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(run, _SCHEMA)


_SCHEMA = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
           "payload_bytes long, payload binary")


def _row(r: Record, with_payload: bool) -> tuple:
    page = lambda name: int(x) if (x := r.headers.get(name, "::").rstrip(">").split(":")[2]).lstrip("-").isdigit() else None
    payload = payload_of(r) if r.headers["WARC-Type"] == "response" else None
    url = r.headers["WARC-Target-URI"]
    return (page("WARC-Record-ID"), urllib.parse.unquote(url), r.headers["WARC-Type"],
            r.headers["WARC-Payload-Digest"].removeprefix("sha1:"), page("WARC-Refers-To"),
            None if payload is None else len(payload), payload if with_payload else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def resolve(records_: DataFrame) -> DataFrame:
    """Revisits with the length of the payload they stand for, looked up by digest."""
    sizes = (records_.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("_d"))
             .agg(F.max("payload_bytes").alias("_bytes")))
    return records_.join(sizes, same_key(F.col("payload_digest"), F.col("_d"))).select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Archive all pages, read the archives back, one row per page."""
    manifest = write_archives(pages, min_bytes)
    root = scratch_path(pages.sparkSession, "warc")
    return resolve(stage(read_archives(manifest, root, with_payload=False).drop("payload"), "warc-records"))
