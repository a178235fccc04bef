"""WARC archives: a writer with revisit records, and a splittable reader.

Each record is a gzip member of its own. A reading task gets a byte range of an
archive: it scans for the magic of gzip from the range's start, decodes the
header of each candidate and takes it for a member only if a WARC record begins
there; it owns the records that start in its range, follows them from member to
member, and reads the last one past the range's end.

Archives are written by tasks under a name of their own, and count once they are
listed in the manifest table, which holds the files of finished tasks only; a lost or
repeated task leaves nothing but an unlisted file. Files are reached by
``pyarrow.fs``, so the shared folder may be in any store it knows.

Defined results: a null html is an empty payload; a null url is left out; control
characters in a url are percent-encoded; of equal payloads (of ``min_bytes`` or more)
all rows with the smallest page id are responses, so repeated rows of it are too; a
null id is never the smallest unless all are null; other columns are ignored. Payloads that themselves
hold a gzipped WARC are told from members only where the range does not start inside them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import MAX_BATCH_BYTES, by_arrow, pieces, stored, utf8
from pulsegrid.session import work_dir

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
ARCHIVE = 256 << 20
BLOCK = 1 << 18
DATE = "2024-01-01T00:00:00Z"
#: The name of records, and the profile of revisits (fixed value of the WARC standard).
URN = "urn:pulsegrid:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, record_type string, url string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{URN}{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?[0-9]+)>", urn or "")
    return int(found[1]) if found else None


def record(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """One gzip member that holds one record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items() if v is not None), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    uri = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {
        "WARC-Record-ID": _urn(page_id), "WARC-Date": DATE, "WARC-Target-URI": uri,
        "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Refers-To": _urn(first) if revisit else None, "WARC-Profile": PROFILE if revisit else None,
    }
    return record("revisit" if revisit else "response", headers, http if revisit else http + payload)


def marked(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, first_id, revisit``: which page each payload was met at first."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html").alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    # Pages of payloads that are met once keep out of the join; the minimum is combined on the map side.
    met = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    out = rows.join(stored(met, "payloads"), "sha1", "left").drop("sha1")
    return out.withColumn("revisit", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))


def write(pages: DataFrame, *, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write archives of all pages below ``folder`` (a new one in the shared place); returns the manifest ``path, bytes, records``."""
    place = folder or work_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(place)
        fs.create_dir(root, recursive=True)
        out, path, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]},
                                              schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))
        for batch in (part for b in batches for part in pieces(b, MAX_BATCH_BYTES)):
            for r in zip(*(batch[c] for c in ("page_id", "url", "payload", "first_id", "revisit"))):
                if out is None:
                    path, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                    about = b"software: pulsegrid\r\nformat: WARC File Format 1.1\r\n"
                    size += out.write(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE,
                                                          "Content-Type": "application/warc-fields"}, about))
                size += out.write(page_record(*(x.as_py() for x in r)))
                n += 1
                if size >= ARCHIVE:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
    rows = marked(pages, min_bytes=min_bytes).select("page_id", "url", "payload", "first_id", "revisit")
    return stored(by_arrow(rows, run, "path string, bytes long, records long"), "manifest").withColumn("root", F.lit(place))


def member(file, at: int) -> tuple[bytes, int] | None:
    """The text of the gzip member at ``at`` and the place behind it, or None if no WARC record begins there."""
    unpack, parts, pos, begun = zlib.decompressobj(31), [], at, b""
    while not unpack.eof:
        file.seek(pos)
        data = file.read(BLOCK)
        if not data:
            return None
        try:
            parts.append(unpack.decompress(data))
        except zlib.error:
            return None
        pos += len(data)
        begun = (begun + parts[-1][:7])[:7]
        if not b"WARC/1.".startswith(begun):
            return None
    return (b"".join(parts), pos - len(unpack.unused_data)) if len(begun) == 7 else None


def members(file, start: int, end: int) -> Iterator[bytes]:
    """The records that start in ``[start, end)``."""
    at, known = start, start == 0
    while at < end:
        if known:
            found = member(file, at)
            if found is None:
                raise ValueError(f"no record at byte {at}, where one should be")
            yield found[0]
            at = found[1]
            continue
        file.seek(at)
        # Two bytes more than the range may begin a magic, not hold one.
        window = file.read(min(BLOCK, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        while hit >= 0 and member(file, at + hit) is None:
            hit = window.find(MAGIC, hit + 1)
        if hit >= 0:
            at, known = at + hit, True
        else:
            at += max(1, len(window) - len(MAGIC) + 1)


def parsed(raw: bytes) -> dict | None:
    """The page of a record, its digest checked against its payload; None for other kinds of records."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = int(re.search(rb"(?i)\r\nContent-Length: *([0-9]+)", http)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != said or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    return {"page_id": _page(headers["warc-record-id"]), "record_type": kind, "url": headers.get("warc-target-uri"),
            "payload": payload if kind == "response" else None, "payload_bytes": said, "payload_digest": digest,
            "refers_to": _page(headers.get("warc-refers-to"))}


def read(manifest: DataFrame, *, split: int = SPLIT) -> DataFrame:
    """All pages of the archives in ``manifest``, a task to each range of ``split`` bytes; columns as in ``RECORD``."""
    ranges = manifest.filter("bytes > 0").select("root", "path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                fs, _ = pyarrow.fs.FileSystem.from_uri(r["root"])
                with fs.open_input_file(r["path"]) as file:
                    for raw in members(file, r["start"], min(r["start"] + split, r["bytes"])):
                        page = parsed(raw)
                        if page:
                            rows.append(page)
                            held += len(raw)
                        if held > MAX_BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return by_arrow(ranges.repartition(tasks, "path", "start"), run, RECORD)
