"""WARC archives in seekable Zstandard bundles.

A task writes the rows that it reads as WARC records, a bundle of bounded size after the other. Records are grouped into frames
that decompress alone; the bundle ends with a seek table in a skippable frame (compressed and full size and checksum of each
frame, then their number and a magic number), so any zstd tool reads it whole, and a reader that seeks needs the footer and one frame.
An index table maps each record identifier to bundle, frame and the record's offset and length within the frame.

Of equal payloads of MIN_REVISIT bytes or more one is written, as `response`; the others are `revisit` records that refer to it.
Bundles are named by the attempt that wrote them, and only those in the index count, so a lost executor leaves no half record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, quoted, shared_folder

#: Equal payloads of so many bytes or more are written once.
MIN_REVISIT = 1_000
#: Bytes of records in a frame, and of frames in a bundle, about; a larger record is a frame of its own.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 32 << 20
#: Tasks that read bundles, at most; else one a bundle.
MAX_READERS = 10_000
#: A digest with more than this share of the rows meets them without a shuffle; there are 1 / HOT_SHARE of them at most.
HOT_SHARE = 0.001
DATE = "1970-01-01T00:00:00Z"
# fixed values: the seekable format's magic numbers and descriptor (bit 7: frames have checksums)
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, DESCRIPTOR = 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER, _HEAD, _ENTRY = struct.Struct("<IBI"), struct.Struct("<II"), struct.Struct("<III")


def _checksum(frame: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF


def _open(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(uri)


class BundleWriter:
    """Appends records; each gets the frame that holds it and its offset there."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        fs, path = _open(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.frame_bytes, self.zstd = fs.open_output_stream(path, compression=None), frame_bytes, zstandard.ZstdCompressor(level)
        self.frames: list[tuple[int, int, int]] = []
        self.written, self.held = 0, bytearray()

    def add(self, record: bytes) -> tuple[int, int]:
        if self.held and len(self.held) + len(record) > self.frame_bytes:
            self.flush()
        at = len(self.frames), len(self.held)
        self.held += record
        return at

    def flush(self) -> None:
        if self.held:
            frame = self.zstd.compress(bytes(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), len(self.held), _checksum(self.held)))
            self.written += len(frame)
            self.held = bytearray()

    def close(self) -> None:
        self.flush()
        table = b"".join(_ENTRY.pack(*f) for f in self.frames) + _FOOTER.pack(len(self.frames), DESCRIPTOR, SEEKABLE_MAGIC)
        self.out.write(_HEAD.pack(SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number; raises ValueError where footer or checksum don't fit."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = _open(uri)
        self.file, self.zstd = fs.open_input_file(path), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, descriptor, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError(f"{uri}: no seek table")
        raw = self.file.read_at(n * _ENTRY.size, size - _FOOTER.size - n * _ENTRY.size)
        self.frames, at = [], 0
        for i in range(n):
            packed, full, check = _ENTRY.unpack_from(raw, i * _ENTRY.size)
            self.frames.append((at, packed, full, check))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, full, check = self.frames[i]
        import zstandard

        try:
            data = self.zstd.decompress(self.file.read_at(packed, at), max_output_size=full)
        except zstandard.ZstdError as e:
            raise ValueError(f"frame {i} is damaged") from e
        if len(data) != full or _checksum(data) != check:
            raise ValueError(f"frame {i} is damaged")
        return data

    def close(self) -> None:
        self.file.close()


def record_uri(name: str | None) -> str:
    """Identifier of the record of a row's id; ids as text, null has one of its own."""
    return "<urn:page>" if name is None else f"<urn:page:{quote(name, safe='')}>"


def id_of(uri: str) -> str | None:
    return None if uri == "<urn:page>" else unquote(uri[len("<urn:page:") : -1])


def warc_record(name: str | None, url: str | None, digest: bytes, size: int, payload: bytes | None, refers_to: str | None, date: str = DATE) -> bytes:
    """A response with its payload, or (refers_to is set) a revisit with the response's HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if refers_to is not None else http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_uri(name)}", f"WARC-Date: {date}"]
    if url is not None:
        safe_url = "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)
        head.append(f"WARC-Target-URI: {safe_url}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_uri(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(frame: bytes, at: int = 0) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields in lower case, block) of each record from an offset on."""
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        version, *lines = frame[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no record at {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin, size = end + 4, int(fields["content-length"])
        if frame[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} doesn't end where it says")
        yield at, begin + size + 4 - at, fields, frame[begin : begin + size]
        at = begin + size + 4


def roles(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = MIN_REVISIT) -> DataFrame:
    """(id, url, payload, digest, size, refers_to): refers_to is the greatest id of the rows with the same payload, where that is
    another id and the payload has `least` bytes or more; such rows lose their payload.

    Digests of a thousandth of the rows or more are at most a thousand, so they are broadcast; other equal payloads meet in a join
    by digest, in which all further rows are keyed by themselves.
    """
    payload = F.coalesce(F.col(quoted(payload_col)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(url_col)).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("id", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("size"))
    shared = cut(rows.filter(F.col("size") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).filter("n > 1 AND last IS NOT NULL"))
    limit = max(2, int(rows.count() * HOT_SHARE))
    hot, cold = shared.filter(F.col("n") >= limit).select("digest", F.col("last").alias("hot_last")), shared.filter(F.col("n") < limit).select(F.col("digest").alias("key"), F.col("last").alias("cold_last"))

    def referred(df: DataFrame, last: str) -> DataFrame:
        other = F.col(last).isNotNull() & ~F.col("id").eqNullSafe(F.col(last))
        df = df.withColumn("refers_to", F.coalesce("refers_to", F.when(other, F.col(last))))
        return df.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))

    rows = referred(rows.withColumn("refers_to", F.lit(None).cast(rows.schema["id"].dataType)).join(F.broadcast(hot), "digest", "left"), "hot_last")
    alone = F.col("hot_last").isNotNull() | (F.col("size") < least)
    rows = rows.withColumn("key", F.when(alone, F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string"))).otherwise(F.col("digest")))
    return referred(rows.join(cold, "key", "left"), "cold_last").select("id", "url", "payload", "digest", "size", "refers_to")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes bundles below `folder` (a URI that all executors reach) and the index, which is returned as read again:
    (record_id, id, record_type, bundle, frame, offset, length).

    Null payloads are empty; rows with equal ids get a record each under one identifier (equal payloads with the greatest id
    are all responses), a null id never becomes the one referred to unless all are null, when all are responses; null urls leave
    the field out. Other columns are ignored, whatever their names; an empty table gives an empty index and no bundle.
    """
    rows = roles(pages, id_col, url_col, payload_col, least)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumns({"id": F.col("id").cast("string"), "refers_to": F.col("refers_to").cast("string")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, bundle, n, out = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", None, 0, []
        for batch in batches:
            ids, urls, payloads, digests, sizes, refers = batch.columns
            for i in range(len(batch)):
                own, refer = ids[i].as_py(), refers[i].as_py()
                record = warc_record(own, urls[i].as_py(), bytes.fromhex(digests[i].as_py()), sizes[i].as_py(), payloads[i].as_py(), refer)
                if bundle is None:
                    file = f"bundle-{name}-{n:04d}.warc.zst"
                    bundle, n = BundleWriter(f"{folder}/bundles/{file}", frame_bytes), n + 1
                    bundle.add(warcinfo())
                frame, offset = bundle.add(record)
                out.append((record_uri(own), own, "response" if refer is None else "revisit", file, frame, offset, len(record)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
                if len(out) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
                    out = []
        if bundle is not None:
            bundle.close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _INDEX.types, strict=True)], schema=_INDEX)

    found = rows.mapInArrow(run, "record_id string, id string, record_type string, bundle string, frame int, offset bigint, length bigint")
    found.withColumn("id", F.col("id").cast(kind)).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


_INDEX = pa.schema([("record_id", pa.string()), ("id", pa.string()), ("record_type", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
_READ = pa.schema([("id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])


def warcinfo(date: str = DATE) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    """What a record says; a response's digest and size are taken from its payload and held against the head."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head).group(1))
    refers = fields.get("warc-refers-to")
    if fields["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"{fields['warc-record-id']}: the payload isn't the one that was written")
    return id_of(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, fields["warc-type"], refers and id_of(refers), payload if payloads else None


def read_warc(spark: SparkSession, folder: str, wanted: DataFrame | None = None, payloads: bool = False) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of the archives' records.

    Without `wanted` every bundle of the index is read through, frame by frame. With `wanted` (a table with record_id) just the
    frames that hold those records are, and each record at its offset. Payloads are null unless asked for, and for revisits.
    """
    index = spark.read.parquet(f"{folder}/index")
    kind = index.schema["id"].dataType.simpleString()
    if wanted is not None:
        index = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
        bundles = index.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("frame", "offset"))).alias("places"))
    else:
        bundles = index.groupBy("bundle").agg(F.lit(None).cast("array<struct<frame:int,offset:bigint>>").alias("places"))

    tasks = max(1, min(MAX_READERS, index.select("bundle").distinct().count()))  # a given number isn't coalesced: rows are few, bundles large

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _READ.types, strict=True)], schema=_READ)

        for batch in batches:
            for item in batch.to_pylist():
                bundle = BundleReader(f"{folder}/bundles/{item['bundle']}")
                if item["places"] is None:
                    for i in range(len(bundle.frames)):
                        out = [_row(fields, block, payloads) for _, _, fields, block in parse_records(bundle.frame(i)) if fields["warc-type"] != "warcinfo"]
                        if out:
                            yield emit(out)
                else:
                    last, data = None, b""
                    for place in item["places"]:
                        if place["frame"] != last:
                            last, data = place["frame"], bundle.frame(place["frame"])
                        _, _, fields, block = next(parse_records(data, place["offset"]))
                        yield emit([_row(fields, block, payloads)])
                bundle.close()

    found = bundles.repartition(tasks, "bundle").mapInArrow(run, "id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary")
    return found.withColumns({"id": F.col("id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives every page in the shared folder, then reads the archives back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_warc(spark, folder).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
