"""WARC archives: one gzip member per record, written and read by Spark tasks.

Pages with equal payloads are found by joining their digests to the smallest id per digest
(summed per task before the shuffle; a page that is a third of the table only makes a skewed
join that Spark splits). The first becomes a ``response`` record, the others ``revisit``
records that refer to it. The reader goes through a file from its start, decompressing as it
goes, takes records by their content length and verifies their digests.

Record ids are version 8 UUIDs that carry the page id, so references need no lookup table.

Rules for odd input: a null html is an empty payload; a null url has no target header; payloads
below ``least_bytes`` are all responses; pages with the same id and payload are alike in all,
so if theirs is the smallest id all of them are responses; null ids come after all others and
are read back as null. An empty table gives a set without files. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader

from . import files
from .shared import byte_digest

DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 18
NO_ID = "<urn:uuid:00000000-0000-8000-8000-000000000000>"
COLUMNS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
READ_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def record_id(page_id: int | None) -> str:
    """66 bits of a version 8 UUID: a mark that an id is there, then the id."""
    if page_id is None:
        return NO_ID
    h = f"{page_id & 0xFFFFFFFFFFFFFFFF:016x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8001-8000-{h[12:]}00000000>"


def page_of(record: str | None) -> int | None:
    if record is None or record == NO_ID:
        return None
    h = record.removeprefix("<urn:uuid:").removesuffix(">").replace("-", "")
    n = int(h[:12] + h[20:24], 16)
    return n - (1 << 64) if n >> 63 else n


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([] if url is None else ["WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A")]),
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"] if revisit else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class Members:
    """The bytes of consecutive gzip members, decompressed as they are asked for."""

    def __init__(self, src):
        self.src, self.raw, self.out = src, b"", bytearray()
        self.unpacker = None
        self.ended = False

    def _more(self) -> bool:
        """Decompresses a little more of the member in hand; false at its end."""
        if not self.raw:
            self.raw = self.src.read(CHUNK)
            if not self.raw:
                raise ValueError("a record is cut off")
        self.out += self.unpacker.decompress(self.raw, CHUNK)
        self.raw = self.unpacker.unconsumed_tail
        if self.unpacker.eof:
            self.raw = self.unpacker.unused_data
        return not self.unpacker.eof

    def next(self) -> bool:
        """Goes to the next member; false after the last."""
        if not self.raw:
            self.raw = self.src.read(CHUNK)
        if not self.raw:
            return False
        self.unpacker, self.out = zlib.decompressobj(31), bytearray()
        return True

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (k := self.out.find(mark, start)) < 0:
            start = max(0, len(self.out) - len(mark))
            if self.unpacker.eof or not self._more() and mark not in self.out:
                raise ValueError("a record has no end of its header")
        found = bytes(self.out[:k])
        del self.out[: k + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.out) < n:
            if self.unpacker.eof:
                raise ValueError("a record is shorter than its length says")
            self._more()
        found = bytes(self.out[:n])
        del self.out[:n]
        return found

    def rest(self) -> bytes:
        while not self.unpacker.eof:
            self._more()
        return bytes(self.out)


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(src) -> Iterator[tuple]:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of each
    record; payload is null for revisits. A digest or length that is off raises ValueError."""
    members = Members(src)
    while members.next():
        head = _headers(members.until(b"\r\n\r\n"))
        block = members.take(int(head["content-length"]))
        if members.rest() != b"\r\n\r\n":
            raise ValueError("a record goes on after its length")
        if head["warc-block-digest"] != "sha1:" + sha1_base32(block):
            raise ValueError(f"block digest of {head['warc-record-id']} is off")
        http, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(_headers(http)["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
        revisit = head["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or sha1_base32(payload) != digest):
            raise ValueError(f"payload digest of {head['warc-record-id']} is off")
        yield page_of(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], page_of(head.get("warc-refers-to")), size, digest, None if revisit else payload


class WarcFiles(DataSource):
    """format("warc_gz"): writes (page_id, url, html, refers_to, revisit), reads records."""

    @classmethod
    def name(cls) -> str:
        return "warc_gz"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema):
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite: bool):
        return WarcWriter(self.options["path"])


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, batches):
        path = files.fresh_file(self.folder, ".warc.gz")
        fs, at = files.resolve(path)
        n = size = 0
        with fs.open_output_stream(at, compression=None) as out:
            for batch in batches:
                for r in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                    record = record_bytes(r["page_id"], r["url"], (r["html"] or "").encode(), r["refers_to"], r["revisit"])
                    out.write(record)
                    n, size = n + 1, size + len(record)
        return files.Written(TaskContext.get().partitionId(), path, n, size)

    def commit(self, messages):
        files.commit(self.folder, messages)

    def abort(self, messages):
        files.abort(messages)


class WarcReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self):
        return files.parts(self.folder) or [files.FilePart("", 0)]

    def read(self, part):
        if not part.file:
            return
        fs, at = files.resolve(part.file)
        make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), READ_SCHEMA, strict=True)], schema=READ_SCHEMA)
        with fs.open_input_stream(at, compression=None) as src:
            rows, held = [], 0
            for r in read_records(src):
                rows.append(r)
                held += len(r[6] or b"") + 200
                if held >= 4 << 20:
                    yield make(rows)
                    rows, held = [], 0
            if rows:
                yield make(rows)


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to and revisit for every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = rows.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, byte_digest(F.col("html"))))
    # only payloads that occur more than once need to find their original
    firsts = keyed.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    joined = keyed.join(firsts.select("digest", "first_id"), "digest", "left")
    revisit = F.coalesce(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, folder: str, *, least_bytes: int = 0) -> None:
    pages.sparkSession.dataSource.register(WarcFiles)
    with_originals(pages, least_bytes).write.format("warc_gz").mode("append").save(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(WarcFiles)
    return spark.read.format("warc_gz").load(folder)
