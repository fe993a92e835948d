"""Operator 13, WARC archives: whole-file gzip made into a member per record, with an index.

1. ``write_archives``: each task writes the pages it reads as archives of some megabytes,
   each one gzip stream as a crawler leaves it, and returns a narrow row per record.
   Pages are not shuffled.
2. ``repeated``: of records with equal payloads (SHA-1 and length) that with the smallest
   page_id is the first. What is shuffled is narrow and combined before; only digests
   that occur twice or more are joined back, over ``SALTS`` tasks each, so a payload that
   a third of all pages share lands in no single task.
3. ``normalise``: each archive's stream is inflated once, piece by piece. Every record is
   written as a gzip member of its own, repeats as revisit records that hold the HTTP
   head only, and a sidecar index ``<archive>.idx`` gets a line per record: offset,
   length, page, type.
4. ``read_archives``: members are opened at their offsets in the index; the payload of a
   response is measured and hashed as it is inflated and must meet its digest, a revisit
   tells its payload's length and digest in its head.

Records and inflated streams pass in pieces of 256 KB; an archive is closed at
``ARCHIVE_BYTES`` or ``ARCHIVE_RECORDS``, so neither a task nor an index grows with the
table. Archives have unique names and count once the row that names them is written: what
a lost task leaves behind is never read, and it is written again by its retry.

Defined results: a null html is an empty payload, and empty payloads are equal; a null
``page_id`` comes after all others, and a revisit of such a record refers to null; of
repeated rows one is the response; a null or odd url is written as it can be, without
white space; an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import open_store, table
from martflow.plans.staging import stage, staging_dir

ARCHIVE_BYTES = 32 << 20
ARCHIVE_RECORDS = 20_000
SALTS = 16
LEVEL = 4
_PIECE = 256 << 10
_GZIP = 16 + zlib.MAX_WBITS
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
RECORD = "archive string, number long, page_id long, sha1 binary, payload_bytes long"
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _name(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"null" if page_id is None else str(page_id).encode())


def _page(name: str) -> int | None:
    told = name.removeprefix("<urn:page:").removesuffix(">")
    return None if told == "null" else int(told)


def response_head(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """Everything of a response record before its payload."""
    told = "".join((url or "").split()).encode()
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
        % len(payload)
    )
    lines = [
        b"WARC/1.1",
        b"WARC-Type: response",
        b"WARC-Record-ID: " + _name(page_id),
        b"WARC-Target-URI: " + told,
        b"WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % (len(http) + len(payload)),
    ]
    return b"\r\n".join(lines) + _END + http


def fields(head: bytes) -> dict[str, str]:
    """The fields of a WARC or HTTP head, by lower-case name."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


class Inflated:
    """The bytes of gzip members in a row, inflated as they are asked for."""

    def __init__(self, source):
        self.source = source
        self.inflater = None  # of the member that is open
        self.packed = b""
        self.held = b""

    def _more(self) -> bool:
        """Some more bytes in ``held``; False at the end of the stream."""
        while True:
            self.packed = self.packed or self.source.read(_PIECE)
            if self.inflater is None:
                if not self.packed:
                    return False
                self.inflater = zlib.decompressobj(_GZIP)
            more = self.inflater.decompress(self.packed, _PIECE)
            if self.inflater.eof:
                self.packed, self.inflater = self.inflater.unused_data, None
            elif self.packed or more:
                self.packed = self.inflater.unconsumed_tail
            else:
                raise ValueError("a gzip stream ends before its end")
            if more:
                self.held += more
                return True

    def head(self) -> bytes | None:
        """Bytes up to an empty line, which is taken too; None at the end."""
        while not (held := self.held.lstrip(b"\r\n")):  # what closes the record before
            if not self._more():
                return None
        self.held, looked = held, 0
        while (at := self.held.find(_END, looked)) < 0:
            looked = max(0, len(self.held) - len(_END) + 1)
            if not self._more():
                raise ValueError("a record ends in its head")
        head, self.held = self.held[:at], self.held[at + len(_END) :]
        return head

    def body(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in pieces."""
        while length:
            if not self.held and not self._more():
                raise ValueError("a record ends in its body")
            piece, self.held = self.held[:length], self.held[length:]
            length -= len(piece)
            yield piece


class Members:
    """Writes gzip members one after the other and knows where each begins."""

    def __init__(self, sink, level: int = LEVEL):
        self.sink, self.level = sink, level
        self.offset = 0
        self.packer = None

    def put(self, piece: bytes) -> None:
        if self.packer is None:
            self.packer = zlib.compressobj(self.level, zlib.DEFLATED, _GZIP)
        self._write(self.packer.compress(piece))

    def close_member(self) -> None:
        if self.packer is not None:
            self._write(self.packer.flush())
            self.packer = None

    def _write(self, packed: bytes) -> None:
        if packed:
            self.sink.write(packed)
            self.offset += len(packed)


def _rows(rows: list[tuple], ddl: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    named = [column.split() for column in ddl.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in named]
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in named])


def write_archives(
    pages: DataFrame,
    folder: str,
    archive_bytes: int = ARCHIVE_BYTES,
    archive_records: int = ARCHIVE_RECORDS,
) -> DataFrame:
    """Write a response record for each page, whole archives as one gzip stream.

    Returns (archive, number, page_id, sha1, payload_bytes) per record.
    """
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )

    def write(batches):
        store, base = open_store(folder)
        sink, members, name, rows, size = None, None, None, [], 0
        for batch in batches:
            for page_id, url, payload in zip(
                batch.column("page_id").to_pylist(),
                batch.column("url").to_pylist(),
                batch.column("payload"),
                strict=True,
            ):
                payload = payload.as_py()
                if sink is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    sink = store.open_output_stream(f"{base}/{name}", compression=None)
                    members, size = Members(sink), 0
                members.put(response_head(page_id, url, payload))
                members.put(payload)
                members.put(_END)
                sha1 = hashlib.sha1(payload).digest()
                rows.append((name, len(rows), page_id, sha1, len(payload)))
                size += len(payload)
                if size >= archive_bytes or len(rows) >= archive_records:
                    members.close_member()
                    sink.close()
                    yield _rows(rows, RECORD)
                    sink, rows = None, []
        if sink is not None:
            members.close_member()
            sink.close()
            yield _rows(rows, RECORD)

    return stage(read.mapInArrow(write, RECORD), "warc-records")


def repeated(records: DataFrame, least_bytes: int = 0, salts: int = SALTS) -> DataFrame:
    """(archive, number, refers_to) of records whose payload an earlier page has.

    Earlier is the smaller ``page_id``, for repeated ids the record's place.
    Payloads of fewer than ``least_bytes`` bytes do not count as repeats.
    """
    place = F.struct(
        F.col("page_id").isNull().alias("unknown"), "page_id", "archive", "number"
    )
    long_enough = records.where(F.col("payload_bytes") >= least_bytes)
    long_enough = long_enough.withColumn("place", place)
    first = long_enough.groupBy("sha1", "payload_bytes").agg(
        F.count(F.lit(1)).alias("records"), F.min("place").alias("first")
    )
    first = first.where("records > 1").select(
        "sha1", "payload_bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    salt = F.pmod(F.xxhash64("archive", "number"), F.lit(salts)).cast("int")
    met = long_enough.withColumn("salt", salt).join(first, ["sha1", "payload_bytes", "salt"])
    met = met.where(F.col("place") != F.col("first"))
    return met.select("archive", "number", F.col("first.page_id").alias("refers_to"))


def _revisit_head(head: bytes, refers_to: int | None, block: int) -> bytes:
    """A response's WARC head as that of a revisit with ``block`` bytes."""
    told = [b"WARC/1.1"]
    for line in head.split(b"\r\n")[1:]:
        name = line.split(b":", 1)[0].lower()
        if name == b"warc-type":
            line = b"WARC-Type: revisit"
        elif name == b"content-length":
            line = b"Content-Length: %d" % block
        told.append(line)
    told += [b"WARC-Profile: " + _PROFILE, b"WARC-Refers-To: " + _name(refers_to)]
    return b"\r\n".join(told)


def normalise_stream(
    source, sink, revisits: Iterator[tuple[int, int | None]] = iter(()), level: int = LEVEL
) -> Iterator[dict]:
    """Rewrite a gzip stream of WARC records, each as a member of its own.

    ``revisits`` are (number, page referred to), ascending, of the records to be written
    as revisits. Yields a line of the index for each record.
    """
    inflated, members = Inflated(source), Members(sink, level)
    to_revisit = next(revisits, None)
    number = 0
    while (head := inflated.head()) is not None:
        told = fields(head)
        body = inflated.body(int(told["content-length"]))
        start = members.offset
        kind = told["warc-type"]
        if to_revisit and to_revisit[0] == number:
            kind = "revisit"
            http, at = b"", -1
            for piece in body:  # the payload is read over
                if at < 0:
                    http += piece
                    at = http.find(_END)
            http = http[: at + len(_END)]
            members.put(_revisit_head(head, to_revisit[1], len(http)) + _END + http)
            to_revisit = next(revisits, None)
        else:
            members.put(head + _END)
            for piece in body:
                members.put(piece)
        members.put(_END)
        members.close_member()
        yield {
            "offset": start,
            "length": members.offset - start,
            "id": told.get("warc-record-id"),
            "type": kind,
        }
        number += 1
    if to_revisit:
        raise ValueError(f"an archive ends before its record {to_revisit[0]}")


def normalise(records: DataFrame, revisits: DataFrame, folder: str, target: str) -> DataFrame:
    """Rewrite archives record by record, with an index beside each.

    ``records`` are those of ``write_archives``, ``revisits`` those of ``repeated``.
    Returns (archive, records, bytes); a row for each new archive in ``target``.
    """
    spark = records.sparkSession
    store, base = open_store(target)
    store.create_dir(base, recursive=True)
    revisits = revisits.withColumn("again", F.lit(True))
    told = records.select("archive", "number").join(revisits, ["archive", "number"], "left")
    archives = records.select("archive").distinct().count()
    # Rows of an archive are narrow and no more than its records; each is a task's at most.
    dealt = told.repartition(max(1, archives), "archive").sortWithinPartitions("archive", "number")
    ddl = "archive string, records long, bytes long"

    def rewrite(batches):
        read_from, source_base = open_store(folder)
        store, base = open_store(target)

        def one(archive: str, again: list[tuple[int, int | None]]):
            name = f"{uuid.uuid4().hex}.warc.gz"
            count = 0
            lines = []
            with (
                read_from.open_input_stream(f"{source_base}/{archive}", compression=None) as source,
                store.open_output_stream(f"{base}/{name}", compression=None) as sink,
            ):
                for line in normalise_stream(source, sink, iter(again)):
                    lines.append(json.dumps(line))
                    count += 1
                size = sink.tell()
            with store.open_output_stream(f"{base}/{name}.idx", compression=None) as sink:
                sink.write("".join(f"{line}\n" for line in lines).encode())
            return _rows([(name, count, size)], ddl)

        archive, again = None, []
        for batch in batches:
            for own, number, repeat, page in zip(
                *(batch.column(c).to_pylist() for c in ("archive", "number", "again", "refers_to")),
                strict=True,
            ):
                if own != archive:
                    if archive is not None:
                        yield one(archive, again)
                    archive, again = own, []
                if repeat:
                    again.append((number, page))
        if archive is not None:
            yield one(archive, again)

    return stage(dealt.mapInArrow(rewrite, ddl), "warc-archives")


def read_member(source, offset: int, length: int) -> tuple:
    """The record of a member: (page_id, payload bytes, digest, type, page referred to)."""
    source.seek(offset)
    inflated = Inflated(_Part(source, length))
    told = fields(inflated.head())
    length = int(told["content-length"])
    http = inflated.head()
    kind = told["warc-type"]
    digest = told["warc-payload-digest"].removeprefix("sha1:")
    page_id = _page(told["warc-record-id"])
    if kind == "revisit":
        size = int(fields(http)["content-length"])
        return page_id, size, digest, kind, _page(told["warc-refers-to"])
    sha1, size = hashlib.sha1(), 0
    for piece in inflated.body(length - len(http) - len(_END)):
        sha1.update(piece)
        size += len(piece)
    if _digest(sha1.digest()) != digest:
        raise ValueError(f"the payload of page {page_id} does not meet its digest")
    return page_id, size, digest, kind, None


class _Part:
    """So many bytes of a file from where it stands."""

    def __init__(self, source, length: int):
        self.source, self.left = source, length

    def read(self, size: int) -> bytes:
        piece = self.source.read(min(size, self.left))
        self.left -= len(piece)
        return piece


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """The records of archives, each read at its offset in the index."""
    spread = archives.select("archive")
    spread = spread.repartition(max(1, spread.count()), "archive")

    def read(batches):
        store, base = open_store(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with store.open_input_stream(f"{base}/{archive}.idx", compression=None) as index:
                    lines = index.read().decode().splitlines()
                rows = []
                with store.open_input_file(f"{base}/{archive}") as source:
                    for line in map(json.loads, lines):
                        rows.append(read_member(source, line["offset"], line["length"]))
                        if len(rows) == 10_000:
                            yield _rows(rows, READ)
                            rows = []
                if rows:
                    yield _rows(rows, READ)

    return spread.mapInArrow(read, READ)


def op13_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, made into members, and read back."""
    folder = f"{staging_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = write_archives(table(spark, sf_dir, "pages"), f"{folder}/streams")
    archives = normalise(records, repeated(records), f"{folder}/streams", f"{folder}/members")
    return read_archives(archives, f"{folder}/members")


#: What the archives hold, from the pages themselves; 5 digits of hexadecimal are 4 of base 32.
OP13_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), firsts AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS digest,
    min(page_id) OVER (PARTITION BY payload) AS first_id
  FROM payloads
)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(digest, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""
