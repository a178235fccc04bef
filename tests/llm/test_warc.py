"""WARC: exact round trips, ranges of any size, candidates that are no members."""

import base64
import gzip
import hashlib
import io

import pytest

from pulsegrid.llm import warc
from pulsegrid.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, payload string, first_id long"


def plain(rows, min_bytes=0):
    """What each page must give: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    out = []
    for k, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= min_bytes and first.get(h or "", k) != k
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((k, len(raw), digest, "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


ROWS = [(5, "http://a/b?c=d e\r\nWARC-Type: x", "<p>same</p>"), (3, "http://a", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "", None), (2, "u", ""),
        (4, "u", "é\r\n\r\nWARC/1.1\r\n\r\nHTTP/1.1 200\r\nContent-Length: 3"), (6, "u", "x" * 3_000_000), (7, "u", "y"), (7, "u", "y"), (8, "u", "y"),
        (None, "u", "y"), (None, "u", "only null ids"), (None, "u", "only null ids"), (10, "u", "\u001f\u008b\u0008 \x00")]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, tmp_path, min_bytes):
    frame = spark.createDataFrame([(*r, "x", 1) for r in ROWS], PAGES).repartition(3)
    manifest = warc.write(frame, min_bytes=min_bytes, folder=f"{tmp_path}/w")
    assert sum(r.records for r in manifest.collect()) == len(ROWS)
    for split in (warc.SPLIT, 101):
        got = warc.read(manifest, split=split)
        assert found(got) == plain(ROWS, min_bytes)
    texts = {r.page_id: bytes(r.payload).decode() for r in got.collect() if r.record_type == "response" and r.page_id}
    assert all(texts[k] == (h or "") for k, _, h in ROWS if k in texts) and texts[4] == ROWS[5][2]
    for r in manifest.collect():
        with gzip.open(r.path) as f:
            assert f.read().count(b"WARC-Type: ") >= r.records
    assert warc.read(warc.write(frame.limit(0), folder=f"{tmp_path}/none")).count() == 0


def test_every_range_owns_its_records(rng):
    pages = [bytes(rng.integers(0, 256, int(n), dtype="uint8")) for n in rng.integers(0, 3000, 40)]
    # A false magic in incompressible data, and a member that is no record.
    pages[3] = warc.MAGIC * 50 + gzip.compress(b"no record at all")
    raw = b"".join(warc.page_record(i, "u", p, None, False) for i, p in enumerate(pages))
    for split in (1, 7, 64, 1000, len(raw)) if len(raw) < 70_000 else (64, 1000, len(raw)):
        got = [warc.parsed(m)["page_id"] for s in range(0, len(raw), split) for m in warc.members(io.BytesIO(raw), s, min(s + split, len(raw)))]
        assert got == list(range(40)), split


def test_damage_is_an_error():
    one = warc.page_record(1, "u", b"payload", None, False)
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(one[:-9]), 0, 5))
    with pytest.raises(ValueError):
        warc.parsed(gzip.decompress(one).replace(b"payload\r", b"PAYLOAD\r"))


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(QUERIES["op5_warc"](spark, sf_dir)) == plain(rows)
