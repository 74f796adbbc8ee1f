"""Web archives: one gzip member per record, written once, read back in byte ranges.

Writing. A page is a response record with its payload, or, where the same payload of at least
``LEAST_BYTES`` bytes is kept under another page, a revisit that names that page and holds the
headers alone. Of the pages with one payload the largest id is the response. Digests, not payloads,
decide this; the digest's one row is joined to its pages, so that a payload a third of
all pages share stays spread over tasks. Names of archives hold the attempt that wrote them, and
only those in the listing that `write_archives` gives are read: what a repeated or lost
attempt leaves, whatever order its rows had, replaces nothing.

Reading. An archive is cut into ranges of bytes, whatever lies at their edges. A task looks
for the magic number of gzip in its range, and takes a place for a member when it decodes to a
whole WARC header with type, id and a length in digits. It owns the records that start in its range and reads
past the end for the last. Behind a member it goes on at once; where a member is
damaged it looks for the next magic number.

Defined results: a null payload is empty; rows with one page id and one payload are responses
if the id is the largest with it; a null url has no target header, a null page id is kept
as such and refers to nothing; an empty table writes no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import fresh_folder, partitions, ship, written
from evalflow.llm.files import Reader, Writer

LEAST_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20
_MORE = 1 << 16

_MAGIC = b"\x1f\x8b\x08"
_ID = "<urn:page:{}>"
_DATE = "2024-01-01T00:00:00Z"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _info() -> bytes:
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:info>"), ("WARC-Date", _DATE)],
        b"format: WARC File Format 1.1\r\n",
    )


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """The gzip member of a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _ID.format(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~")))
    if refers_to is None:
        return _member(headers, http + payload)
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return _member([*headers, ("WARC-Profile", profile), ("WARC-Refers-To", _ID.format(refers_to))], http)


def _write(folder: str, archive_bytes: int):
    def run(batches):
        task, attempt, number, out = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None

        def close():
            out.close()
            columns = [pa.array([name()]), pa.array([out.size], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["path", "size"])

        def name():
            return f"{folder}/pages-{task:06d}-{attempt}-{number:06d}.warc.gz"

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            for page, url, html, digest, refers in zip(*columns):
                if out is None:
                    out = Writer(name())
                    out.write(_info())
                out.write(record(page, url, html.encode(), digest, refers))
                if out.size >= archive_bytes:
                    yield close()
                    number, out = number + 1, None
        if out is not None:
            yield close()

    return run


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of ``(page_id, url, html)`` in ``folder``; gives their ``(path, size)``."""
    ship(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long_enough = F.octet_length("html") >= LEAST_BYTES
    kept = rows.filter(long_enough).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    # alone in its digest a page needs no look at others
    kept = kept.filter("n > 1 and kept is not null").select("digest", "kept")
    dealt = rows.join(kept, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(F.col("page_id").isNotNull() & (F.col("kept") != F.col("page_id")), F.col("kept")).alias("refers_to"),
    )
    return written(dealt.mapInArrow(_write(folder, archive_bytes), "path string, size long"), "archives")


# -- reading --------------------------------------------------------------------------------


class _Range:
    """Bytes of a file from a place on; reads on as they are asked for."""

    def __init__(self, path: str, start: int, length: int):
        self._file, self.start = Reader(path), start
        self.size = self._file.size
        self.data = self._file.read(start, length + _MORE)

    def grow(self) -> bool:
        """More bytes behind those there; False at the end of the file."""
        more = self._file.read(self.start + len(self.data), max(_MORE, len(self.data)))
        self.data += more
        return bool(more)

    def close(self) -> None:
        self._file.close()

    def header_at(self, at: int) -> bool:
        """Whether the bytes there decode to the whole header of a record."""
        unpacker, head, fed = zlib.decompressobj(31), b"", at
        try:
            while b"\r\n\r\n" not in head:
                if unpacker.eof or head[:5] != b"WARC/"[: len(head)] or fed >= len(self.data) and not self.grow():
                    return False
                piece = self.data[fed : fed + 1024]
                fed += len(piece)
                head += unpacker.decompress(piece)
        except zlib.error:
            return False
        version, *lines = head.partition(b"\r\n\r\n")[0].split(b"\r\n")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(b":") for line in lines)}
        named = fields.get(b"warc-type") and fields.get(b"warc-record-id")
        return version.startswith(b"WARC/") and bool(named) and fields.get(b"content-length", b"").isdigit()

    def member_at(self, at: int) -> tuple[bytes, int] | None:
        """The member's content and the place behind it; None where it is damaged."""
        unpacker, parts, fed = zlib.decompressobj(31), [], at
        try:
            while not unpacker.eof:
                if fed >= len(self.data) and not self.grow():
                    return None
                piece = self.data[fed : fed + (1 << 20)]
                fed += len(piece)
                parts.append(unpacker.decompress(piece))
        except zlib.error:
            return None
        return b"".join(parts), fed - len(unpacker.unused_data)


def records(path: str, start: int, length: int):
    """Contents of the records that start in a range of an archive."""
    part = _Range(path, start, length)
    at, sure = 0, False
    try:
        while True:
            if not sure:
                at = part.data.find(_MAGIC, at)
                if at < 0 or at >= length:
                    return
            if at >= length or start + at >= part.size:
                return
            found = part.member_at(at) if part.header_at(at) else None
            if found is None:
                at, sure = at + 1, False
            else:
                content, at = found
                sure = part.header_at(at) if at < length else True
                yield content
    finally:
        part.close()


def parsed(content: bytes) -> dict | None:
    """What a record says of its page; None for other records."""
    head, _, block = content.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind = headers.get("WARC-Type")
    if kind not in ("response", "revisit"):
        return None
    block = block[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not what its header says")

    def page(name: str) -> int | None:
        text = headers.get(name, "<urn:page:None>")[10:-1]
        return None if text == "None" else int(text)

    return {
        "page_id": page("WARC-Record-ID"),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


_PAGE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_PAGE_SQL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def _read(range_bytes: int, with_payload: bool):
    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                rows, size = [], 0
                for content in records(path, start, range_bytes):
                    row = parsed(content)
                    if row is not None:
                        rows.append(row if with_payload else row | {"payload": None})
                        size += len(content) if with_payload else 0
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _PAGE)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _PAGE)

    return run


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """A row per response and revisit of the archives ``(path, size)``."""
    ship(files.sparkSession)
    ranges = files.select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    ).repartition(partitions(files.sparkSession), "path", "start")
    found = ranges.mapInArrow(_read(range_bytes, with_payload), _PAGE_SQL)
    return found if with_payload else found.drop("payload")


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    folder = fresh_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages, folder), with_payload=False).drop("url")


SQL = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT payload_digest AS g, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM d LEFT JOIN k ON payload_digest = g""",
}
QUERIES = {"op5_warc": op5_warc}
