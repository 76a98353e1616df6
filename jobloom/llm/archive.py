"""Web archives (WARC 1.1) in seekable Zstandard bundles, with an index from record identifiers to places in them.

Tasks pack their records into frames of about FRAME_BYTES each, compressed independently, and frames into bundles; a record is
never cut, so a longer one has a frame of its own. A bundle ends with a seek table in a skippable frame, as the seekable format of
Zstandard has it: the compressed and plain size of every frame, their number and a closing mark. Whoever has a bundle finds any frame
from its last bytes, and the index gives the frame of a record and the record's offset in the plain frame, so that a single
record costs one frame. Any Zstandard reader also reads a bundle from its start to its end.

Of records with equal payloads, the one with the smallest key holds the payload (``response``), all others point to it
(``revisit``) and hold its header only. Digests of payloads that occur under more than one key are found by a grouped count of
digests; they are sent to the tasks up to MOST_SENT of them, and joined with the records beyond.

Bundles are rows (``bundle``, ``content``, ``records``): executors and driver reach only what Spark stores, so the table is written
by Spark, and read by ``read_records`` and ``find_records`` wherever it lies.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import give_back, modest_batches
from jobloom.scratch import materialize

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 256 << 10, 4 << 20, 3
#: Digests of repeated payloads that are sent to the tasks.
MOST_SENT = 100_000
#: Fixed values of the seekable format: marks of the skippable frame that holds the seek table, and of its end.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = "bundle string, content binary, records array<struct<record_id: string, frame: int, offset: long, length: long>>"
RECORDS = (
    "record_id string, key string, url string, record_type string, refers_to_id string, refers_to string, payload binary, "
    "payload_bytes long, payload_digest string, bundle string, frame int, offset long"
)


def record_id(key: str | None, digest: str) -> str:
    """The identifier of a record: its key, if it has one, and the digest of its payload."""
    return f"urn:x-record:{'' if key is None else '=' + quote(key, safe='')}:{digest}"


def key_of(identifier: str) -> str | None:
    part = identifier.split(":")[2]
    return unquote(part[1:]) if part else None


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode("ascii")


def warc_record(key: str | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """A response record, or without ``payload`` a revisit of the record ``refers_to``; its block begins with the header of the answer."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload or b"")
    fields = [
        "WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: <{record_id(key, digest)}>",
        f"WARC-Date: {date}", *([] if url is None else [f"WARC-Target-URI: {quote(url, safe=URI_CHARS)}"]),
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).hexdigest())}",
        *([] if payload is not None else [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Characters of an address that stand in it as they are; a stored address is decoded once, so a % is written as %25.
URI_CHARS = "!#$&'()*+,/:;=?@[]~"


def parse_record(data: bytes | memoryview, offset: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """Fields, header of the answer, payload and the offset behind the record that begins at ``offset``."""
    data = bytes(data) if offset == 0 and not isinstance(data, bytes) else data
    stop = data.index(b"\r\n\r\n", offset)
    lines = data[offset:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines[1:])}
    block = data[stop + 4 : stop + 4 + int(fields["content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, head, payload, stop + 4 + len(block) + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame, from the compressed and plain sizes of the frames."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE)


def frames_of(content: bytes) -> list[tuple[int, int, int]]:
    """Start, compressed and plain size of each frame, from the seek table at the end."""
    number, descriptor, mark = struct.unpack("<IBI", content[-9:])
    if mark != SEEKABLE:
        raise ValueError("the bundle does not end with a seek table")
    step = 12 if descriptor & 0x80 else 8  # with a checksum for each frame, or without
    begin = len(content) - 9 - number * step
    out, at = [], 0
    for k in range(number):
        packed, plain = struct.unpack_from("<II", content, begin + k * step)
        out.append((at, packed, plain))
        at += packed
    return out


def frame(content: bytes, place: tuple[int, int, int]) -> bytes:
    start, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=plain)


class Bundler:
    """Collects records and gives finished bundles as rows."""

    def __init__(self, name: str):
        self.name, self.number = name, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True)
        self.open: list[bytes] = []
        self.size = 0
        self.begin()

    def begin(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.records: list[dict] = []

    def close_frame(self) -> None:
        if self.open:
            plain = b"".join(self.open)
            self.frames.append(self.packer.compress(plain))
            self.sizes.append((len(self.frames[-1]), len(plain)))
            self.open, self.size = [], 0

    def add(self, identifier: str, record: bytes) -> dict | None:
        """A finished bundle, if this record has filled it."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self.close_frame()
        self.records.append({"record_id": identifier, "frame": len(self.frames), "offset": self.size, "length": len(record)})
        self.open.append(record)
        self.size += len(record)
        if self.size >= FRAME_BYTES:
            self.close_frame()
        return self.finish() if sum(s for s, _ in self.sizes) >= BUNDLE_BYTES else None

    def finish(self) -> dict | None:
        self.close_frame()
        if not self.frames:
            return None
        row = {"bundle": f"{self.name}-{self.number:05d}", "content": b"".join([*self.frames, seek_table(self.sizes)]), "records": self.records}
        self.number += 1
        self.begin()
        return row


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``original``, the smallest key among records of an equal payload of at least ``least_bytes`` bytes, where keys differ.

    ``pages`` has ``key``, ``payload`` (binary) and ``sha1`` (hexadecimal). Null keys come last.
    """
    narrow = pages.where(F.octet_length("payload") >= least_bytes).select("sha1", "key")
    # A digest stays if a second key has it; equal keys are each as small as the other.
    repeated = narrow.groupBy("sha1").agg(F.min("key").alias("original"), F.max("key").alias("last"), F.count("key").alias("keys"), F.count("*").alias("n"))
    repeated = repeated.where("original < last OR (keys > 0 AND keys < n)").select("sha1", "original")
    repeated = materialize(repeated, "repeated-payloads")
    few = repeated.limit(MOST_SENT + 1).count() <= MOST_SENT
    return pages.join(F.broadcast(repeated) if few else repeated, "sha1", "left")


def write_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Bundles (``bundle``, ``content``, ``records``) of a record for every row; write them, as they are made anew at each reading.

    A null payload is empty. A null address is left out; other addresses are stored percent-encoded. Among equal payloads of at
    least ``least_bytes`` bytes the rows with the smallest key are responses (repeated rows with that key each, under one
    identifier), others revisit it; null keys come last, and where all are null all are responses. Columns of other names are not
    read. An empty table gives no bundle. A payload is stored whole, up to the two gigabytes that a value may have.
    """
    modest_batches(pages.sparkSession)
    data = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), data.alias("payload"))
    rows = with_originals(rows.withColumn("sha1", F.sha1("payload")), least_bytes)
    revisit = F.col("original").isNotNull() & ~F.col("key").eqNullSafe(F.col("original")) & (F.octet_length("payload") >= least_bytes)
    rows = rows.select(
        F.col("key").cast("string").alias("key"), "url", F.when(~revisit, F.col("payload")).alias("payload"),
        F.octet_length("payload").alias("size"), "sha1", F.when(revisit, F.col("original").cast("string")).alias("original"),
        F.spark_partition_id().alias("part"),
    )
    kinds = pa.schema([
        ("bundle", pa.string()), ("content", pa.binary()),
        ("records", pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))),
    ])

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = None
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    bundler = bundler or Bundler(f"part-{row['part']:06d}")
                    digest = base32(row["sha1"])
                    refers_to = None if row["payload"] is not None else record_id(row["original"], digest)
                    record = warc_record(row["key"], row["url"], row["payload"], row["size"], digest, refers_to)
                    done = bundler.add(record_id(row["key"], digest), record)
                    if done:
                        yield pa.RecordBatch.from_pylist([done], kinds)
        done = bundler.finish() if bundler else None
        if done:
            yield pa.RecordBatch.from_pylist([done], kinds)
        give_back()

    return rows.mapInArrow(of_task, BUNDLES)


def index(bundles: DataFrame) -> DataFrame:
    """``record_id``, and where the record lies: ``bundle``, ``frame``, ``offset`` in the plain frame, ``length``."""
    return bundles.select("bundle", F.inline("records")).select("record_id", "bundle", "frame", "offset", "length")


def _record(data: bytes, offset: int, bundle: str, number: int) -> tuple[dict, int]:
    fields, head, payload, stop = parse_record(data, offset)
    identifier, refers_to = fields["warc-record-id"][1:-1], fields.get("warc-refers-to")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(head.rpartition(b": ")[2])
    if fields["warc-type"] == "response" and (len(payload) != size or base32(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError(f"the payload of {identifier} in {bundle} is damaged")
    row = {
        "record_id": identifier, "key": key_of(identifier), "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": fields["warc-type"], "refers_to_id": refers_to and refers_to[1:-1], "refers_to": key_of(refers_to[1:-1]) if refers_to else None,
        "payload": payload if fields["warc-type"] == "response" else None, "payload_bytes": size, "payload_digest": digest,
        "bundle": bundle, "frame": number, "offset": offset,
    }
    return row, stop


def read_records(bundles: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of ``bundles`` (``bundle``, ``content``), frame by frame from the seek tables.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, of revisits too; ``payload`` is null there, and everywhere
    without ``with_payload``. Payloads are checked against their digests; a damaged one is an error.
    """

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bundle, content = batch.column("bundle")[k].as_py(), batch.column("content")[k].as_py()
                for number, place in enumerate(frames_of(content)):
                    data, at, rows = frame(content, place), 0, []
                    while at < len(data):
                        row, at = _record(data, at, bundle, number)
                        rows.append(row if with_payload else row | {"payload": None})
                    yield pa.RecordBatch.from_pylist(rows, ROWS)
        give_back()

    return bundles.select("bundle", "content").mapInArrow(of_task, RECORDS)


ROWS = pa.schema([
    *[(name, pa.string()) for name in ("record_id", "key", "url", "record_type", "refers_to_id", "refers_to")], ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()),
])


def find_records(bundles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (``record_id``) by way of the index: only the frames that hold one are decompressed.

    A record that is stored several times comes once for each; one asked for twice does not come twice.
    """
    places = index(bundles).join(wanted.select("record_id").distinct(), "record_id").select("bundle", "frame", "offset")
    # A group is the places within one bundle, so it is no larger than the index of the bundle.
    places = places.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset"))).alias("places"))

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bundle, content = batch.column("bundle")[k].as_py(), batch.column("content")[k].as_py()
                frames, rows, number, data = frames_of(content), [], -1, b""
                for place in batch.column("places")[k].as_py():
                    if place["frame"] != number:
                        number = place["frame"]
                        data = frame(content, frames[number])
                    rows.append(_record(data, place["offset"], bundle, number)[0])
                yield pa.RecordBatch.from_pylist(rows, ROWS)

    return bundles.select("bundle", "content").join(places, "bundle").mapInArrow(of_task, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Result of the query: what the archives of all pages say of each, read back."""
    kind = pages.schema["page_id"].dataType
    bundles = materialize(write_records(pages, "page_id", "url", "html"), "bundles")

    def id_of(name: str) -> Column:
        return F.col(name).cast(kind)

    return read_records(bundles, with_payload=False).select(
        id_of("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_of("refers_to").alias("refers_to")
    )
