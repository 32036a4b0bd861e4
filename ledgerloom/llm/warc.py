"""WARC archives: written, normalised to one gzip member per record with an offset index, and read back by the index.

Archives that were compressed as one stream cannot be entered in the middle. The normaliser inflates such a stream once, in
pieces of bounded size, rewrites every record as a gzip member of its own and notes where each begins, so that readers
after it fetch single records and share one archive. Files live in the shared folder; a task writes under a name of its
own and renames at the end, so a task that runs again or twice leaves one whole file.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import folder, narrow_side, written
from .words import as_bytes

#: Uncompressed bytes after which a writer begins another archive.
ARCHIVE_BYTES = 256 << 20
PIECE = 1 << 20
LEVEL = 6
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: bytes | None, payload: bytes, first: int | None, date: str) -> bytes:
    """One WARC record. A response holds the payload behind an HTTP header; a revisit names the record that has it."""
    target = _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url or b"")
    digest = b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind, block, more = b"response", http + payload, b""
    if first is not None:
        kind, block = b"revisit", http
        more = b"WARC-Refers-To: <urn:pages:%d>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n" % first
    head = b"WARC/1.1\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:pages:" + (b"%d" % page if page is not None else b"") + b">\r\n"
    head += b"WARC-Date: " + date.encode() + b"\r\nWARC-Target-URI: " + target + b"\r\nWARC-Payload-Digest: " + digest + b"\r\n" + more
    return head + b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


class Inflated:
    """A gzip stream of any number of members, read in pieces; holds one piece and what is asked for."""

    def __init__(self, stream):
        self.stream, self.inflate, self.data, self.over = stream, zlib.decompressobj(31), b"", False

    def _more(self) -> bool:
        while not self.over:
            raw = self.inflate.unconsumed_tail or self.inflate.unused_data
            if self.inflate.eof:
                raw = raw or self.stream.read(PIECE)
                if not raw:
                    self.over = True
                    break
                self.inflate = zlib.decompressobj(31)
            else:
                raw = self.inflate.unconsumed_tail or self.stream.read(PIECE)
                if not raw:
                    raise ValueError("the archive ends inside a gzip member")
            got = self.inflate.decompress(raw, PIECE)
            if got:
                self.data += got
                return True
        return False

    def head(self) -> bytes | None:
        """The next record's header with its blank line; None at the end."""
        while (at := self.data.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.data.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        out, self.data = self.data[: at + 4], self.data[at + 4 :]
        return out

    def body(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.data and not self._more():
                raise ValueError("the archive ends inside a record")
            out, self.data = self.data[:size], self.data[size:]
            size -= len(out)
            yield out


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, records): archives of all rows, each one gzip stream; executed once and written as a table.

    Of rows with equal payloads of ``least`` bytes or more that with the smallest key is a response, the others revisit it. A
    null payload is empty. A null key cannot be the smallest; such a row is a response if no equal payload has a key. Rows with
    equal keys and payloads are all responses if theirs is the smallest key. Other columns are not looked at.
    """
    spark = pages.sparkSession
    place = folder(spark, "warc")
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    # Only payloads that come more than once, with the smallest key: merged before the shuffle.
    shared = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first")
    marked = rows.join(narrow_side(written(shared, "shared"), 40), "digest", "left")
    other = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page")), F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        fs, base = _files(place)
        fs.create_dir(base, recursive=True)
        out = None
        for batch in batches:
            columns = [batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()]
            for page, target, data, first in zip(*columns):
                if out is None:
                    name, count, size, pack = f"{base}/part-{part:06d}-{number:04d}.warc.gz", 0, 0, zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    own = f"{name}.{uuid.uuid4().hex}"
                    out = fs.open_output_stream(own)
                made = record(page, target, data, first, date)
                out.write(pack.compress(made))
                count, size = count + 1, size + len(made)
                if size >= archive_bytes:
                    out.write(pack.flush())
                    out.close()
                    fs.move(own, name)
                    yield pa.RecordBatch.from_pydict({"archive": [f"{place}/{name.rsplit('/', 1)[1]}"], "records": [count]})
                    out, number = None, number + 1
        if out is not None:
            out.write(pack.flush())
            out.close()
            fs.move(own, name)
            yield pa.RecordBatch.from_pydict({"archive": [f"{place}/{name.rsplit('/', 1)[1]}"], "records": [count]})

    return written(marked.select("page", "url", "payload", other.alias("first")).mapInArrow(write, "archive string, records long"), "archives")


def normalise(archives: DataFrame) -> DataFrame:
    """(archive, record, offset, length): each archive rewritten with one member per record, and its index; a written table.

    Next to an archive ``x.warc.gz`` come ``x.records.warc.gz`` and the sidecar ``x.records.index``, one JSON line per record.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = _files(archive)
                stem, mark = path.removesuffix(".warc.gz") + ".records", uuid.uuid4().hex
                target = archive.removesuffix(".warc.gz") + ".records.warc.gz"
                at, number = 0, 0
                ids, offsets, lengths = [], [], []
                with fs.open_input_stream(path, compression=None) as raw, fs.open_output_stream(f"{stem}.warc.gz.{mark}", compression=None) as out, fs.open_output_stream(f"{stem}.index.{mark}", compression=None) as index:
                    source = Inflated(raw)
                    while (head := source.head()) is not None:
                        head = head.lstrip(b"\r\n")
                        known = fields(head)
                        pack, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                        for data in itertools.chain([head], source.body(int(known["content-length"]) + 4)):
                            made = pack.compress(data)
                            out.write(made)
                            size += len(made)
                        made = pack.flush()
                        out.write(made)
                        size += len(made)
                        line = {"record": number, "id": known.get("warc-record-id"), "type": known.get("warc-type"), "offset": at, "length": size}
                        index.write(json.dumps(line).encode() + b"\n")
                        ids.append(number)
                        offsets.append(at)
                        lengths.append(size)
                        at, number = at + size, number + 1
                        if len(ids) == 10_000:
                            yield pa.RecordBatch.from_pydict({"archive": [target] * len(ids), "record": pa.array(ids, pa.int64()), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())})
                            ids, offsets, lengths = [], [], []
                fs.move(f"{stem}.warc.gz.{mark}", f"{stem}.warc.gz")
                fs.move(f"{stem}.index.{mark}", f"{stem}.index")
                yield pa.RecordBatch.from_pydict({"archive": [target] * len(ids), "record": pa.array(ids, pa.int64()), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())})

    # An archive is a task: a stream cannot be entered in the middle.
    tasks = max(1, archives.count())
    return written(archives.select("archive").repartition(tasks).mapInArrow(rewrite, "archive string, record long, offset long, length long"), "index")


def read_records(index: DataFrame, slice_records: int = 1024) -> DataFrame:
    """(archive, record, type, page, url, payload, payload_digest, refers_to) of every indexed record, fetched by offset.

    Runs of ``slice_records`` records are read as one range, so an archive is shared by many tasks. A payload that does not have the
    digest in its header is an error; revisits have none.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, begin, size in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = _files(archive)
                with fs.open_input_file(path) as f:
                    source = Inflated(pa.BufferReader(f.read_at(size, begin)))
                out: dict[str, list] = {k: [] for k in ("archive", "type", "page", "url", "payload", "payload_digest", "refers_to")}
                held = 0
                while (head := source.head()) is not None:
                    known = fields(head.lstrip(b"\r\n"))
                    block = b"".join(source.body(int(known["content-length"]) + 4))[:-4]
                    body = block.partition(b"\r\n\r\n")[2] if known["warc-type"] == "response" else None
                    digest = known["warc-payload-digest"].removeprefix("sha1:")
                    if body is not None and sha1_base32(body) != digest:
                        raise ValueError(f"damaged record in {archive}")
                    number = lambda name: int(m[1]) if (m := re.search(r"urn:pages:(-?\d+)", known.get(name, ""))) else None
                    for k, v in zip(out, (archive, known["warc-type"], number("warc-record-id"), known["warc-target-uri"], body, digest, number("warc-refers-to"))):
                        out[k].append(v)
                    held += len(block)
                    if held > 16 << 20:
                        yield _batch(out)
                        out, held = {k: [] for k in out}, 0
                if out["type"]:
                    yield _batch(out)

    ranges = index.groupBy("archive", F.floor(F.col("record") / slice_records).alias("slice")).agg(F.min("offset").alias("begin"), F.sum("length").alias("size"))
    return ranges.select("archive", "begin", "size").mapInArrow(fetch, "archive string, type string, page long, url string, payload binary, payload_digest string, refers_to long")


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))
