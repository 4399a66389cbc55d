"""WARC archives, index first.

``write_archives`` lets every task write one archive of gzip members to the
shared folder and returns the index: for each record its archive, offset,
length, URL and payload digest. ``read_records`` takes any selection of index
rows, sorts them by archive and offset, joins ranges that lie close together
into reads of bounded size and parses the records those reads hold. Files are
opened through Arrow's file systems, so the folder may be local, HDFS or an
object store. A task that runs twice writes a second archive of another name;
only the index of the run that counts points to its file.

Defined cases: null html is an empty payload; null ids and URLs are left out of
the header and come back as null; of equal payloads of at least ``MIN_PAYLOAD``
bytes the row with the smallest page id is the response (every row with that
same id and payload, if rows repeat) and others are revisits; rows without an
id are never referred to; an empty table gives an empty index.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_PAYLOAD = 100
MAX_GAP = 64 * 1024
MAX_READ = 4 * 1024 * 1024

INDEX = "archive string, offset long, length long, url string, payload_digest string, page_id long, record_type string, refers_to long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, refers_to for every row.

    Digests are grouped with a partial minimum, so a payload that a third of
    all rows share costs one row per task.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    firsts = (
        rows.filter(F.length("payload") >= MIN_PAYLOAD)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    return (
        rows.join(firsts, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first_id")))
        .drop("first_id")
    )


def _record(row: dict) -> bytes:
    revisit = row["record_type"] == "revisit"
    payload = row["payload"]
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        # As given, for any reader; only what would break the header line is escaped, under a name of its own.
        plain = not _CONTROL.search(row["url"])
        head.append(f"WARC-Target-URI: {row['url']}" if plain else f"X-Escaped-Target-URI: {quote(row['url'], safe='')}")
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page-Id: {row['refers_to']}", f"X-Payload-Length: {len(payload)}",
        ]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """The index rows of archives that the tasks write into ``folder``. Store the result before using it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, out, at = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                member = gzip.compress(_record(row), 1, mtime=0)
                if out is None:
                    out = store.open_output_stream(path, compression=None)
                out.write(member)
                index.append({**row, "archive": path.rpartition("/")[2], "offset": at, "length": len(member)})
                at += len(member)
            names = [c.strip().split()[0] for c in INDEX.split(",")]
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in index], _INDEX_ARROW)
        if out is not None:
            out.close()

    return rows.mapInArrow(run, INDEX)


_INDEX_ARROW = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])
_RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; a digest that does not fit its payload is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"), "url": unquote(fields["X-Escaped-Target-URI"]) if "X-Escaped-Target-URI" in fields else fields.get("WARC-Target-URI"),
        "payload_bytes": number("X-Payload-Length") if revisit else len(payload), "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "payload": None if revisit else payload,
    }


def _reads(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Close ranges of sorted ``(archive, offset, length)`` rows joined: archive, start, end, members."""
    current: tuple[str, int, int, list[tuple[int, int]]] | None = None
    for archive, offset, length in rows:
        if current and archive == current[0] and offset - current[2] <= MAX_GAP and offset + length - current[1] <= MAX_READ:
            current = (archive, current[1], max(current[2], offset + length), [*current[3], (offset, length)])
        else:
            if current:
                yield current
            current = (archive, offset, offset + length, [(offset, length)])
    if current:
        yield current


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows. Reads are spread by archive and stretch of offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        handles: dict = {}
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True))
            for archive, start, end, members in _reads(rows):
                if archive not in handles:
                    for old in handles.values():
                        old.close()
                    handles = {archive: store.open_input_file(f"{base}/{archive}")}
                data = handles[archive].read_at(end - start, start)
                found = [parse_record(zlib.decompress(data[o - start : o - start + n], 31)) for o, n in members]
                if not with_payload:
                    found = [{**f, "payload": None} for f in found]
                yield pa.RecordBatch.from_pylist(found, _RECORD_ARROW)
        for old in handles.values():
            old.close()

    stretch = F.floor(F.col("offset") / (8 * MAX_READ))
    placed = index.select("archive", "offset", "length", stretch.alias("stretch"))
    ordered = placed.repartition("archive", "stretch").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(run, RECORD)

