"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Spark's text writer writes the archives, so that its commit protocol leaves whole files only, on any file system. Its line
separator is an empty skippable frame, which every Zstandard reader passes over. The reader walks frame by frame,
decodes each alone, and checks version, headers, lengths, digests and the record's end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats.
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE_MAGIC = range(0x184D2A50, 0x184D2A60)
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Parts that the pages of one payload are dealt to.
SALTS = 64

SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC[0], 0)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _base32(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def build(record_id: str, url: str | None, payload: bytes, size: int, sha1: bytes, refers: str | None, date: str) -> bytes:
    """A response record, or with ``refers`` a revisit that has the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers else http + payload
    target = _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url or "urn:none")
    head = ["WARC-Type: " + ("revisit" if refers else "response"), f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response"]
    if refers:
        head += [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{_base32(sha1)}", f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    return b"\r\n".join([VERSION, *(h.encode() for h in head), b"", block]) + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """One record's fields; ``error`` says what is wrong with it, or is None."""
    out = {"record_type": None, "record_id": None, "url": None, "date": None, "refers_to": None, "payload_digest": None, "payload_bytes": None, "payload": None, "error": None}
    end = record.find(b"\r\n\r\n")
    if not record.startswith(VERSION + b"\r\n") or end < 0:
        return out | {"error": "no version or no end of headers"}
    fields = {}
    for line in record[len(VERSION) + 2 : end].split(b"\r\n"):
        name, colon, value = line.decode(errors="replace").partition(":")
        if not colon or not name or name != name.strip():
            return out | {"error": f"malformed header: {name[:60]}"}
        fields[name.lower()] = value.strip()
    out |= {"record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id", "").strip("<>") or None, "url": fields.get("warc-target-uri"), "date": fields.get("warc-date")}
    out |= {"refers_to": fields.get("warc-refers-to", "").strip("<>") or None, "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
    if missing := [n for n in NEEDED if not fields.get(n)]:
        return out | {"error": f"missing header: {', '.join(missing)}"}
    length = fields["content-length"]
    block, tail = record[end + 4 : -4], record[-4:]
    if not (length.isascii() and length.isdigit()) or int(length) != len(block) or tail != b"\r\n\r\n":
        return out | {"error": f"content length {length[:20]}, but {len(block)} bytes in the frame's block"}
    if (want := fields.get("warc-block-digest")) and want != f"sha1:{_base32(hashlib.sha1(block).digest())}":
        return out | {"error": "block digest differs"}
    head, gap, payload = block.partition(b"\r\n\r\n")
    said = re.search(rb"(?i)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", head, re.M)
    if not gap or not said:
        return out | {"error": "no HTTP headers or no length in them"}
    out["payload_bytes"] = int(said[1])
    if fields["warc-type"] == "response":
        if len(payload) != out["payload_bytes"]:
            return out | {"error": "payload length differs"}
        if out["payload_digest"] != _base32(hashlib.sha1(payload).digest()):
            return out | {"error": "payload digest differs"}
        out["payload"] = payload
    elif fields["warc-type"] == "revisit" and not out["refers_to"]:
        return out | {"error": "a revisit refers to nothing"}
    return out


def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """Magic number, start and end of each frame. A frame that is cut short or unknown is an error."""
    at, size = 0, len(data)
    try:
        while at < size:
            (magic,) = struct.unpack_from("<I", data, at)
            start = at
            if magic in SKIPPABLE_MAGIC:
                at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            elif magic == FRAME_MAGIC:
                told = data[at + 4]
                alone = told >> 5 & 1
                at += 5 + (1 - alone) + (0, 1, 2, 4)[told & 3] + (alone, 2, 4, 8)[told >> 6]
                last = 0
                while not last:
                    block = int.from_bytes(data[at : at + 3], "little")
                    if at + 3 > size or block >> 1 & 3 == 3:
                        raise ValueError("a block is cut short or of a reserved type")
                    last = block & 1
                    at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
                at += 4 * (told >> 2 & 1)
            else:
                raise ValueError(f"no frame at byte {at}")
            if at > size:
                raise ValueError(f"the frame at byte {start} is cut short")
            yield magic, start, at
    except (struct.error, IndexError) as error:
        raise ValueError("a frame is cut short") from error


def records(data: bytes, largest: int = 1 << 30) -> Iterator[dict]:
    """The records of one archive. What cannot be decoded is a row with ``error`` only; a broken frame ends the archive."""
    reader = zstandard.ZstdDecompressor()
    view, first = memoryview(data), True
    try:
        for magic, start, end in frames(view):
            if magic == DICTIONARY_MAGIC and first:
                found = bytes(view[start + 8 : end])
                if found[:4] == struct.pack("<I", FRAME_MAGIC):
                    found = zstandard.ZstdDecompressor().decompress(found, max_output_size=largest)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(found))
            first = False
            if magic == FRAME_MAGIC:
                try:
                    yield parse(reader.decompress(view[start:end], max_output_size=largest))
                except zstandard.ZstdError as error:
                    yield parse(b"") | {"error": f"frame at byte {start}: {error}"}
    except ValueError as error:
        yield parse(b"") | {"error": str(error)}


def train_dictionary(pages: DataFrame, count: int, size: int = 1 << 16, sample: int = 200, characters: int = 1 << 14) -> bytes:
    """A compression dictionary from ``sample`` of ``count`` rows at most and so many characters of each.

    Rows are taken by the hash of their id and payload: about twice as many as needed pass a threshold, and the least hashes
    are taken of those. The dictionary is an eighth of the sample at most. It changes the archives' size only. Too few pages to train on give a dictionary of their
    plain bytes.
    """
    place = F.pmod(F.xxhash64("page_id", "payload"), F.lit(1 << 40)).alias("place")
    near = pages.select(place, F.substring("payload", 1, characters).alias("payload")).where(F.col("place") < int(min(1, 2 * sample / max(count, 1)) * (1 << 40)))
    taken = near.orderBy("place", "payload").limit(sample).select("payload").collect()
    built = [build("urn:page:0", "http://example.com/", p[0].encode(), 0, b"", None, "1970-01-01T00:00:00Z") for p in taken]
    try:
        return zstandard.train_dictionary(min(size, max(1 << 10, sum(map(len, built)) // 8)), built).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(built) + build("urn:page:0", None, b"", 0, b"", None, "1970-01-01T00:00:00Z"))[-size:]


def _pack(dictionary: bytes, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        out: list[bytes] = []
        size, begun = 0, False
        for batch in batches:
            for row in batch.to_pylist():
                if not begun:
                    out.append(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                    begun = True
                raw = build(row["record_id"], row["url"], (row["payload"] or "").encode(), row["size"], bytes.fromhex(row["sha1"]), row["refers"], date)
                out.append(writer.compress(raw))
                size += len(out[-1])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write_archives(pages: DataFrame, path: str, least_payload: int = 0, archive_bytes: int = 32 << 20, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record for each row of ``pages`` (``page_id``, ``url``, ``html``), in archives of about ``archive_bytes`` of HTML.

    Of rows with equal payloads of at least ``least_payload`` bytes, those of the least ``page_id`` are responses (more than one if
    the id repeats) and the others revisits of it; smaller payloads are responses. Null html is an empty payload. A row
    with a null id is a response only if all rows of its payload have none. A null URL becomes ``urn:none``; control characters
    and spaces in URLs are percent-encoded. Other columns are ignored. No rows give no archives.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    # Only payloads that occur more than once; a row for each, without the payload.
    first = rows.where(F.col("size") >= least_payload).groupBy("sha1").agg(F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1 AND least IS NOT NULL").drop("n")
    total = rows.agg(F.sum("size").alias("n"), F.count("*").alias("pages")).first()
    archives = max(1, -(-(total.n or 0) // archive_bytes))
    # One shuffle deals the pages to archives and meets their payload's first page; a frequent payload is spread by salts.
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).repartition(archives, "sha1", "salt")
    spread = first.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).repartition(archives, "sha1", "salt")
    met = dealt.join(spread.hint("shuffle_hash"), ["sha1", "salt"], "left")
    again = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    made = met.select(
        urn("page_id").alias("record_id"), "url", F.when(~again, F.col("payload")).alias("payload"), "size", "sha1", F.when(again, urn("least")).alias("refers"),
    )
    packed = made.mapInArrow(_pack(train_dictionary(rows, total.pages), date), "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode("ascii")).text(path)


SCHEMA = "record_type string, record_id string, url string, date string, refers_to string, payload_digest string, payload_bytes long, payload binary, error string"


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([(n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string()) for n, t in (x.split(" ") for x in SCHEMA.split(", "))])
    for batch in batches:
        for content in batch["content"]:
            kept, size = [], 0
            for record in records(content.as_buffer()):
                kept.append(record)
                size += len(record["payload"] or b"") + 500
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(kept, schema=kinds)
                    kept, size = [], 0
            yield pa.RecordBatch.from_pylist(kept, schema=kinds)


def read_archives(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """A row for each record of all archives below ``path``; one task reads an archive, which must be below 2 GB.

    ``payload`` is null for revisits, whose ``payload_bytes`` and ``payload_digest`` are those of the full payload. A
    record that is not valid has the reason in ``error``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).schema("path string, modificationTime timestamp, length long, content binary")
    return files.load(path).select("content").mapInArrow(_unpack, SCHEMA)
