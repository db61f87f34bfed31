"""WARC archives written and read by Spark, payloads as chunk rows with running digests.

A record is written as text rows that end in CRLF, one row per chunk of the payload in HTTP's chunked transfer form, cut from
the column's own buffer, so that a long payload is never copied as one value. An archive is read as a stream, one gzip member
after the other: headers, then piece after piece of the payload; each becomes a row of the chunked record table with its
bytes and the digest of the payload up to its end, and no record is held as a whole.

Archives of other writers are read as well: records of any type, payloads with or without transfer coding, with a member for
each record or one for all, or uncompressed. A payload is what follows the HTTP header of a response, a request or a revisit, else the whole block.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.scaling import shared_folder

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 64 << 20
LEAST_REVISIT = 100
CRLF = "\r\n"
#: fixed value of the format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

Batches = Iterator[pa.RecordBatch]


def _plain(value: object) -> str:
    """A header value on one line."""
    return " ".join(str("" if value is None else value).split())


def _record_id(page: int | None, digest: str) -> str:
    """Unique as far as records differ: rows that repeat page and payload are one record."""
    return f"<urn:page:{'none' if page is None else page}:{digest[:16]}>"


def _cuts(payload: memoryview) -> list[int]:
    """Ends of the chunks of a UTF-8 text, none inside a character."""
    ends, at = [], 0
    while at < len(payload):
        at = min(at + CHUNK_BYTES, len(payload))
        while at < len(payload) and payload[at] & 0xC0 == 0x80:
            at -= 1
        ends.append(at)
    return ends


def write_records(date: str) -> Callable[[Batches], Batches]:
    """Text rows of records from (page_id, url, html, payload_bytes, digest, refers_to), refers_to null for responses."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lines: list[bytes] = []
            for k in range(batch.num_rows):
                page, url, _, size, digest, refers = (None if c == 2 else batch.column(c)[k].as_py() for c in range(6))
                http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                head = (
                    f"WARC/1.1{CRLF}WARC-Record-ID: {_record_id(page, digest)}{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: {_plain(url)}{CRLF}"
                    f"WARC-Payload-Digest: sha256:{digest}{CRLF}Content-Type: application/http; msgtype=response{CRLF}"
                )
                if refers is not None:
                    block = f"{http}Content-Length: {size}{CRLF}{CRLF}"
                    head += f"WARC-Type: revisit{CRLF}WARC-Refers-To: {_record_id(refers, digest)}{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}"
                    lines.append(f"{head}Content-Length: {len(block)}{CRLF}{CRLF}{block}{CRLF}".encode())
                    continue
                http += f"Transfer-Encoding: chunked{CRLF}{CRLF}"
                payload = memoryview(batch.column(2)[k].as_buffer())
                ends = _cuts(payload)
                sizes = np.diff([0, *ends]).tolist()
                length = len(http) + sum(len(f"{n:x}") + n + 4 for n in sizes) + len("0") + 4
                first = f"{head}WARC-Type: response{CRLF}Content-Length: {length}{CRLF}{CRLF}{http}".encode()
                for n, end in zip(sizes, ends, strict=True):
                    lines.append(b"%s%x\r\n%s" % (first, n, payload[end - n : end]))
                    first = b""
                    if len(lines) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], ["value"])
                        lines = []
                lines.append(first + b"0\r\n\r\n\r\n")  # the row's own CRLF closes the record
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], ["value"])

    return run


class Stream:
    """Bytes of a file, inflated as they are asked for, member after member, where it is gzip."""

    def __init__(self, packed: memoryview, step: int = 1 << 16):
        self.packed, self.step, self.at, self.buffer = packed, step, 0, bytearray()
        self.inflate = zlib.decompressobj(31) if bytes(packed[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        while True:
            part = self.packed[self.at : self.at + self.step]
            if self.inflate is None:
                self.buffer += part
                self.at += len(part)
                return len(part) > 0
            if self.inflate.eof:
                if bytes(part[:2]) != b"\x1f\x8b":  # the end, or padding behind the last member
                    self.at = len(self.packed)
                    return False
                self.inflate = zlib.decompressobj(31)
            # no more than a few steps at once, however well a payload packs
            out = self.inflate.decompress(part, 16 * self.step)
            used = len(part) - len(self.inflate.unconsumed_tail) - len(self.inflate.unused_data)
            self.at += used
            if out:
                self.buffer += out
                return True
            if not used and not self.inflate.eof:
                raise ValueError("the archive ends within a member")

    def until(self, mark: bytes) -> bytes:
        """Bytes before ``mark``, which is passed over; empty at the end of the file."""
        seen = 0
        while (found := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return b""
        out = bytes(self.buffer[:found])
        del self.buffer[: found + len(mark)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            out = bytes(self.buffer[: min(n, CHUNK_BYTES)])
            del self.buffer[: len(out)]
            n -= len(out)
            if out:
                yield out

    def ended(self) -> bool:
        """Whether nothing but line ends is left."""
        while True:
            line_ends = len(self.buffer) - len(self.buffer.lstrip(b"\r\n"))
            del self.buffer[:line_ends]
            if self.buffer:
                return False
            if not self._more():
                return True


class Block:
    """The block of one record: as many bytes of the stream as its header says."""

    def __init__(self, stream: Stream, length: int):
        self.stream, self.left = stream, length

    def line(self) -> bytes:
        """Bytes up to the next CRLF, which is passed over."""
        line = self.stream.until(CRLF.encode())
        self.left -= len(line) + 2
        if self.left < 0:
            raise ValueError("a record is longer than its header says")
        return line

    def header(self) -> dict[str, str]:
        lines = []
        while self.left and (line := self.line()):
            lines.append(line)
        return _headers(lines)

    def rest(self, n: int | None = None) -> Iterator[bytes]:
        n = self.left if n is None else n
        self.left -= n
        yield from self.stream.pieces(n)

    def chunks(self) -> Iterator[bytes]:
        """The payload of HTTP's chunked transfer coding."""
        while size := int(self.line().split(b";")[0], 16):
            for piece in self.rest(size):
                yield piece
            if self.line():
                raise ValueError("a broken chunk")
        while self.left and self.line():  # trailers
            pass


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(ident: str) -> int | None:
    """The page number in a record id of this writer; other ids have none."""
    found = re.fullmatch(r"<urn:page:(-?\d+)(:\w*)?>", ident or "")
    return int(found[1]) if found else None


_CHUNKS = pa.schema([
    ("archive", pa.string()), ("record", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("date", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int32()), ("chunk_bytes", pa.int64()),
    ("digest_so_far", pa.string()), ("stated_bytes", pa.int64()), ("stated_digest", pa.string()), ("agrees", pa.bool_()),
    ("data", pa.binary()),
])
CHUNK_TABLE = (
    "archive string, record long, record_id string, page_id long, url string, date string, record_type string, refers_to long, "
    "chunk int, chunk_bytes long, digest_so_far string, stated_bytes long, stated_digest string, agrees boolean, data binary"
)


def _checks(stated: str | None):
    """The hash that a digest header names and whether a digest equals it; None where the hash is unknown."""
    name, _, value = (stated or "").partition(":")
    name = name.lower().replace("-", "")
    if not value or name not in hashlib.algorithms_guaranteed or name.startswith("shake"):
        return None, None
    forms = lambda d: (d.hex(), base64.b32encode(d).decode().rstrip("="), base64.b64encode(d).decode())
    return hashlib.new(name), lambda digest: any(value in (f, f.upper()) or value.rstrip("=") == f for f in forms(digest))


def _payload(block: Block, head: dict[str, str]) -> tuple[dict[str, str], Iterator[bytes]]:
    """HTTP header, empty if there is none, and the pieces of the payload."""
    if not head.get("content-type", "").lower().startswith("application/http"):
        return {}, block.rest()
    http = block.header()
    if http.get("transfer-encoding", "").lower() == "chunked" and block.left:
        return http, block.chunks()
    return http, block.rest()


def read_records(data: bool) -> Callable[[Batches], Batches]:
    """Chunk rows of archives given as (path, content), with the bytes of each chunk where ``data`` is set.

    A record without payload is one row without bytes. ``agrees`` stands in a record's last row: whether the digest
    that its header states is that of the payload, null where it states none.
    """

    def record_rows(stream: Stream, path: str, record: int) -> Iterator[tuple]:
        lines = []
        while line := stream.until(CRLF.encode()):
            lines.append(line)
        head = _headers(lines)
        if not lines or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record in {path}, record {record}")
        block = Block(stream, int(head["content-length"]))
        kind = head["warc-type"]
        http, pieces = _payload(block, head)
        start = (
            path, record, head.get("warc-record-id"), _page(head.get("warc-record-id")), head.get("warc-target-uri"), head.get("warc-date"),
            kind, _page(head.get("warc-refers-to")) if kind == "revisit" else None,
        )
        stated = head.get("warc-payload-digest")
        own = stated.removeprefix("sha256:") if stated and stated.startswith("sha256:") else stated
        size = http.get("content-length", "")
        if kind == "revisit":
            for _ in pieces:  # a server may repeat a payload; the record refers to another all the same
                pass
            yield (*start, 0, 0, None, int(size) if size.isdigit() else None, own, None, None)
        else:
            running, (other, equal) = hashlib.sha256(), _checks(stated)
            held, chunk = b"", 0
            for piece in itertools.chain(pieces, [None]):
                if held or piece is None:
                    running.update(held)
                    if other:
                        other.update(held)
                    last = piece is None
                    agrees = equal(other.digest()) if last and other else None
                    yield (*start, chunk, len(held), running.hexdigest(), None, own, agrees, held if data else None)
                    chunk += 1
                held = piece or b""
        for _ in block.rest():
            pass

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                path = batch.column(0)[k].as_py()
                stream = Stream(memoryview(batch.column(1)[k].as_buffer()))
                rows, weight, record = [], 0, 0
                while not stream.ended():
                    for row in record_rows(stream, path, record):
                        rows.append(row)
                        weight += row[9] + 1000
                        if weight >= 1 << 22:
                            yield pa.RecordBatch.from_pylist([dict(zip(_CHUNKS.names, r, strict=True)) for r in rows], _CHUNKS)
                            rows, weight = [], 0
                    record += 1
                yield pa.RecordBatch.from_pylist([dict(zip(_CHUNKS.names, r, strict=True)) for r in rows], _CHUNKS)

    return run


def record_plan(pages: DataFrame, least: int = LEAST_REVISIT, partitions: int | None = None) -> DataFrame:
    """(page_id, url, html, payload_bytes, digest, refers_to) of each page. Only ids and digests meet by digest.

    Pages are dealt into ``partitions`` by digest and id, so that the join with their targets moves payloads once.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    sized = own.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn(
        "digest", F.sha2(F.encode("html", "UTF-8"), 256)
    )
    narrow = sized.filter(F.col("payload_bytes") >= least).select("page_id", "digest")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    again = narrow.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
    again = again.select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct()
    # the digest alone stands for a null page_id, which never has more than one target
    name = F.concat_ws("/", "digest", "page_id")
    named = sized.withColumn("name", name)
    if partitions:
        named = named.repartition(partitions, "name")
    again = again.select(name.alias("name"), "refers_to")
    joined = named.alias("p").join(again.alias("a"), "name", "left")
    return joined.select(
        "p.page_id", "p.url", F.when(F.col("a.refers_to").isNull(), F.col("p.html")).alias("html"),
        "p.payload_bytes", "p.digest", "a.refers_to",
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT, date: str | None = None) -> None:
    """Gzip files of WARC records below ``path``, about ``ARCHIVE_BYTES`` of payload each.

    Of pages with equal payloads of at least ``least`` bytes the smallest page_id is written with its payload, the others
    as revisits to it; rows that repeat that page_id are written like it. Null html is an empty payload, a null
    page_id is kept as null and is never referred to. ``date``: when the pages were fetched, by default now.
    """
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    spark = pages.sparkSession
    archives = max(1, -(-total // ARCHIVE_BYTES), spark.sparkContext.defaultParallelism)
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = record_plan(pages, least, archives).mapInArrow(write_records(date), "value string")
    lines.write.option("lineSep", CRLF).option("compression", "gzip").text(path)


def read_archives(spark, path: str, pattern: str = "part-*", data: bool = True) -> DataFrame:
    """The chunked record table of all archives below ``path``; without ``data`` the payloads are digested and left behind."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInArrow(read_records(data), CHUNK_TABLE)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, and ``intact``: whether the digest of what
    was read is the one stated in the header, true for a revisit, null where none is stated. Works on any number of rows, none included."""
    of_record = chunks.groupBy("archive", "record").agg(
        F.first("page_id").alias("page_id"),
        F.coalesce(F.max("stated_bytes"), F.sum("chunk_bytes")).alias("payload_bytes"),
        F.coalesce(F.max_by("digest_so_far", "chunk"), F.first("stated_digest")).alias("payload_digest"),
        F.first("record_type").alias("record_type"),
        F.first("refers_to").alias("refers_to"),
        F.max("agrees").alias("agrees"),
    )
    return of_record.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.when(F.col("record_type") == "revisit", True).otherwise(F.col("agrees")).alias("intact"),
    )


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes archives, below ``spark.checkpoint.dir`` unless ``path`` is given, and reads them back."""
    path = path or shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path)
    return records(read_archives(pages.sparkSession, path, data=False))
