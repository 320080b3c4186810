"""Web archives: a writer and a splittable reader of compressed WARC files.

Each record is a gzip member of its own. The reader lets Spark scan byte ranges of
the files for the magic bytes of gzip: the text source splits files at any
delimiter, skips to the first one in its range and reads the last piece to its
end, so every piece belongs to the range in which it begins. A piece is a
candidate only, since the magic bytes can occur inside compressed data. A task
validates it by decoding the gzip header and the begin of the record; pieces
that fail continue the member before them. A member that goes on into the
next range, behind such a false begin, is put together from the pieces of both
in a second, small step by file.

Files named ``.gz`` are handed over undecoded as well, by Hadoop's pass-through
codec. Hadoop does not split what has a codec, so such a file is one range, which is
streamed member by member; stored as ``.warc`` the same bytes are read in ranges.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A record's fields that the reader returns.
RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, digest_header string,"
    " payload_bytes long, payload_digest string, payload binary, valid boolean"
)
RECORD_NAMES = [field.split()[0] for field in RECORD.split(", ")]
#: An empty gzip member; appended where a member does not end in a zero byte.
_EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def _header_value(text: str) -> str:
    """A value on one line: control characters, blanks and bytes beyond ASCII are percent-encoded."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in text.encode())


def member(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP header, with the payload's length, but no payload."""
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", None if url is None else _header_value(url)),
        ("WARC-Payload-Digest", f"sha1:{base32}"),
        ("WARC-Profile", None if refers_to is None else REVISIT_PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<{refers_to}>"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(records: DataFrame, path: str) -> None:
    """Write rows (``record_id``, ``url``, ``payload``, ``digest``, ``refers_to``) as archives, a file per task.

    Spark's text writer commits the files, so lost tasks leave nothing behind. It
    ends every row with a delimiter of at least one byte: members end in zero
    bytes (the high byte of their length), of which the last is left to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(begin, 256).to_pylist():
                    data = member(r["record_id"], r["url"], r["payload"] or b"", r["digest"], r["refers_to"])
                    out.append((data if data[-1] == 0 else data + _EMPTY)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    columns = ["record_id", "url", "payload", "digest", "refers_to"]
    rows = records.select(columns).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def is_gzip_header(data: bytes) -> bool:
    """Whether bytes after the magic are the rest of a gzip header: deflate, no reserved flags."""
    return len(data) >= 8 and data[0] == 8 and not data[1] & 0xE0


class Member:
    """A candidate member: its decoder, the pieces it took and what they decode to."""

    def __init__(self):
        self.decoder = zlib.decompressobj(31)
        self.pieces: list[bytes] = []
        self.parts: list[bytes] = []
        self.begin = b""

    def take(self, piece: bytes) -> bool:
        """Decode a piece as the next; false if it cannot be, or if the member is no WARC record."""
        self.pieces.append(piece)
        try:
            part = self.decoder.decompress(MAGIC + piece)
        except zlib.error:
            return False
        self.parts.append(part)
        self.begin = (self.begin + part[:5])[:5]
        return b"WARC/".startswith(self.begin) and not (self.done and len(self.begin) < 5)

    @property
    def decided(self) -> bool:
        return len(self.begin) == 5

    @property
    def done(self) -> bool:
        return self.decoder.eof


def parse_record(data: bytes) -> dict:
    """Fields of a decoded record. The payload of a revisit is the one it refers to; its length is in the HTTP header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    length = int(fields["content-length"])
    block = rest[:length]
    kind, noted = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    hexed = base64.b32decode(noted[5:]).hex() if noted.startswith("sha1:") else None
    payload, size, digest = block, len(block), None
    if "application/http" in fields.get("content-type", ""):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":
            lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size = int(lengths[0]) if lengths else None
    if kind == "revisit":
        payload, digest = None, hexed
    else:
        digest = hashlib.sha1(payload).hexdigest()
    return {
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "digest_header": hexed,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
        "valid": len(block) == length and rest[length:] == b"\r\n\r\n" and digest == (hexed or digest),
    }


class Reader:
    """Records of consecutive pieces. Pieces before the first record are kept as ``loose`` if asked for."""

    def __init__(self, keep_loose: bool):
        self.member: Member | None = None
        self.loose: list[bytes] = []
        self.before = keep_loose  # no record has begun yet

    def piece(self, data: bytes) -> Iterator[dict]:
        """``data`` follows a delimiter, which is not part of it."""
        waiting = [data]
        while waiting:
            data = waiting.pop(0)
            if self.member is None:
                if not is_gzip_header(data):
                    self._not_here(data)
                    continue
                self.member = Member()
            member = self.member
            if not member.take(data):
                # No record begins at the member's first piece, or it was cut off: any later piece may begin one.
                self.member = None
                if not member.decided or member.begin != b"WARC/":
                    self._not_here(member.pieces[0])
                waiting = member.pieces[1:] + waiting
            elif member.done:
                self.before, self.member = False, None
                yield parse_record(b"".join(member.parts))

    def _not_here(self, data: bytes) -> None:
        if self.before:
            self.loose.append(data)

    def rest(self) -> list[bytes]:
        """Pieces that belong to members of other ranges: those before the first record and the unfinished last member's."""
        return self.loose + (self.member.pieces if self.member else [])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives under ``path``, which Spark must be able to read: columns of ``RECORD``.

    Without ``payloads`` that column is null, and only what was measured leaves the reading tasks.
    Members that cannot be decoded (cut off or damaged) have no row. ``valid`` tells
    whether lengths and digest agree with the header. Empty folders give an empty table.
    """
    lines = (
        spark.read.option("lineSep", MAGIC.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        # Files named .gz are handed over as they are. The shaded Hadoop client knows the setting by the second name.
        .option("io.compression.codecs", "org.apache.hadoop.io.compress.PassthroughCodec")
        .option("io.compress.passthrough.extension", ".gz")
        .option("org.apache.hadoop.shaded.io.compress.passthrough.extension", ".gz")
        .text(path)
    )
    pieces = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("value").cast("binary").alias("piece"),
    )
    schema = T.StructType.fromDDL(f"{RECORD}, file string, range long, place int, loose binary")
    arrow = pa.schema(
        [(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in schema]
    )

    def pack(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{k: r.get(k) for k in arrow.names} for r in rows], schema=arrow)

    def found(reader: Reader, piece: bytes) -> list[dict]:
        records = list(reader.piece(piece))
        return records if payloads else [r | {"payload": None} for r in records]

    def close(reader: Reader | None, at) -> list[dict]:
        if reader is None:
            return []
        file, begin = at
        return [{"file": file, "range": begin, "place": k, "loose": x} for k, x in enumerate(reader.rest())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at = None, None
        for batch in batches:
            rows: list[dict] = []
            size = 0
            for file, begin, piece in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (file, begin) != at:
                    rows += close(reader, at)
                    reader, at = Reader(keep_loose=True), (file, begin)
                    if begin == 0:
                        continue  # what stands before the file's first delimiter
                records = found(reader, piece)
                size += sum(len(r["payload"] or b"") for r in records)
                rows += records
                if size > 4 << 20:
                    yield pack(rows)
                    rows, size = [], 0
            yield pack(rows)
        yield pack(close(reader, at))

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members over range borders: an unfinished member's pieces, then the loose ones of the ranges after it."""
        reader, at = None, None
        for batch in batches:
            rows: list[dict] = []
            for file, piece in zip(batch.column("file").to_pylist(), batch.column("loose").to_pylist(), strict=True):
                if file != at:
                    reader, at = Reader(keep_loose=False), file
                rows += found(reader, piece)
            yield pack(rows)

    read = pieces.mapInArrow(run, schema)
    loose = read.where("loose is not null").select("file", "range", "place", "loose").repartition("file")
    stitched = loose.sortWithinPartitions("file", "range", "place").mapInArrow(stitch, schema)
    return read.where("loose is null").select(RECORD_NAMES).union(stitched.select(RECORD_NAMES))


def deduplicated_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Rows for ``write_archives``, with pages of equal payload written once.

    ``pages`` needs ``page_id``, ``url`` and ``html``. Of pages with equal payloads of at
    least ``least_bytes`` bytes, that with the largest id is the response the others
    refer to. Adaptive execution splits the join's partition of a payload that many
    pages share; the other side has one row per payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least_bytes
    latest = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
    joined = rows.join(latest.where("n > 1").drop("n"), "digest", "left")
    refers = F.when(
        large & F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest")), page_uri("latest")
    )
    return joined.select(page_uri("page_id").alias("record_id"), "url", "payload", "digest", refers.alias("refers_to"))


def page_uri(column: str) -> F.Column:
    """Record identifier of a page; a null id gives one without a number."""
    return F.concat(F.lit("urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")))


def page_of(column: str) -> F.Column:
    return F.regexp_extract(column, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages as archives under ``path`` and read them back.

    Result, one row per page: ``page_id``, ``payload_bytes``, ``payload_digest``
    (SHA-1 in hexadecimal), ``record_type``, ``refers_to``, ``valid``. Null html is an
    empty payload. Repeated rows stay repeated: all rows with the largest id of
    a payload are responses. A page without an id refers to the largest id if
    there is one. No pages give no rows.
    """
    write_archives(deduplicated_records(pages), path)
    return read_archives(pages.sparkSession, path, payloads=False).select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
        "valid",
    )
