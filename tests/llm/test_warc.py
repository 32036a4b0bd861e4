from __future__ import annotations

import base64
import gzip
import hashlib
import json
import urllib.parse
from pathlib import Path

import pytest

from ledgerloom.llm import warc


def brute(rows):
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    out = []
    for page, _, html in rows:
        first, data = least.get(html or ""), (html or "").encode()
        again = first is not None and first != page
        out.append((page, base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def local(path):
    return Path(urllib.parse.urlparse(path).path)


def test_round_trip(spark):
    rows = [(i, f"http://x/{i} \n", ["a" * i, None, "", "é\r\n\r\nWARC/1.1"][i % 4]) for i in range(60)]
    rows += [(7, None, "dup"), (7, "u", "dup"), (3, "q", "dup"), (None, None, "dup"), (None, "z", "only"), (90, "big", "xy z" * 1_000_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_archives(df, archive_bytes=3000)
    index = warc.normalise(archives)
    read = warc.read_records(index, 7).collect()
    assert sorted(((r.page, r.payload_digest, r.type, r.refers_to) for r in read), key=str) == brute(rows)
    assert all(base64.b32encode(hashlib.sha1(r.payload).digest()).decode() == r.payload_digest for r in read if r.type == "response")
    # Same bytes, one member per record, and the sidecar says where.
    for a in archives.collect():
        whole = local(a.archive)
        parts = whole.with_name(whole.name.replace(".warc.gz", ".records.warc.gz"))
        assert gzip.decompress(whole.read_bytes()) == gzip.decompress(parts.read_bytes())
        lines = [json.loads(x) for x in parts.with_name(parts.name.replace(".warc.gz", ".index")).read_text().splitlines()]
        assert len(lines) == a.records
        for x in lines:
            assert gzip.decompress(parts.read_bytes()[x["offset"] : x["offset"] + x["length"]]).startswith(b"WARC/1.1")


def test_small_payloads_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (4, "u", "abc"), (3, "u", "abc")], "page_id long, url string, html string")
    read = warc.read_records(warc.normalise(warc.write_archives(df, least=3))).collect()
    assert sorted((r.page, r.type, r.refers_to) for r in read) == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]
    assert warc.read_records(warc.normalise(warc.write_archives(df.limit(0)))).count() == 0


def test_broken_stream():
    import pyarrow as pa

    data = gzip.compress(warc.record(1, b"u", b"x" * 5000, None, "2024-01-01T00:00:00Z"))
    with pytest.raises(ValueError, match="ends inside"):
        source = warc.Inflated(pa.BufferReader(data[:-40]))
        head = warc.fields(source.head())
        list(source.body(int(head["content-length"])))
        source.head()
