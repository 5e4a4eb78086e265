"""Dictionary-compressed WARC files (operator 5).

A Zstandard dictionary is built from a bounded sample of the records.  Every
file starts with a skippable frame that embeds the dictionary, then holds a
``warcinfo`` record and one frame per record, so a file is self-contained and
any record can be decompressed alone.

Among records with equal payloads of at least ``min_revisit`` bytes the one
with the smallest page_id is a ``response``; the others are ``revisit``
records that refer to it and carry headers only (the length of the full
payload is in their HTTP header, its digest in their WARC header).  Smaller
payloads are always responses.  A null html is an empty payload, a null url an
empty URI.  Rows that repeat the smallest page_id with the same payload are
responses too.  A row without page_id never is the one referred to: it is a
revisit if a row with an id has the same payload, a response otherwise.  An
empty table gives no file and no row.  Payloads of any length are written
whole (only the dictionary's sample cuts them); other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize
from .files import new_file, random_access

DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri[len("<urn:page:"):-1]
    return None if name == "none" else int(name)


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in
                   [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or with ``refers_to`` a revisit of that page's response."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    target = CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [("WARC-Record-ID", record_uri(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return warc_record("response", fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    return warc_record("revisit", fields, http)


def parse_record(data: bytes) -> tuple[dict, bytes]:
    """(headers, block) of one record."""
    at = data.index(b"\r\n\r\n")
    lines = data[:at].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = data[at + 4:at + 4 + int(headers["Content-Length"])]
    if data[at + 4 + len(block):] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    return headers, block


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A dictionary of ``samples``; raw content where there are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def frames(f, piece: int = 16 << 10):
    """(dictionary, iterator over decompressed frames) of a file."""
    magic, size = struct.unpack("<II", f.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    held = f.read(size)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held) if held else None)

    def each():
        data = f.read(piece)
        while data:
            one, out = decompressor.decompressobj(), []
            while not one.eof:
                if not data and not (data := f.read(piece)):
                    raise ValueError("the file ends within a frame")
                out.append(one.decompress(data))
                data = one.unused_data if one.eof else b""
            yield b"".join(out)
            data = data or f.read(piece)

    return held, each()


def plan_revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """pages plus ``payload`` and ``refers_to`` (null: response)."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("__sha1", F.sha1("payload"))
    # the payloads stay where they are; digests alone decide
    keys = rows.where(F.length("payload") >= min_revisit).select("page_id", "__sha1")
    first = (keys.groupBy("__sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    revisits = (keys.join(first, "__sha1").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                .where("refers_to is not null").distinct())
    r = revisits.select(F.col("page_id").alias("__id"), F.col("__sha1").alias("__key"), "refers_to")
    return (rows.join(r, (F.col("__sha1") == F.col("__key")) & F.col("page_id").eqNullSafe(F.col("__id")), "left")
            .select("page_id", "url", "payload", "refers_to"))


def dictionary_sample(pages: DataFrame, n: int, sample_records: int, sample_bytes: int, record_bytes: int,
                      date: str) -> list[bytes]:
    """Records of the pages with the smallest hashes, wherever they are stored;
    of a long one its first ``record_bytes`` count, so that none displaces the
    others."""
    share = F.shiftrightunsigned(F.xxhash64("page_id", "url"), 33) / F.lit(float(2**31))
    picked = (pages.select("page_id", "url", F.substring("html", 1, record_bytes).alias("html"), share.alias("share"))
              .where(F.col("share") < 4.0 * sample_records / n).orderBy("share", "page_id", "url", "html")
              .limit(sample_records))
    sample, held = [], 0
    for r in picked.toLocalIterator():
        record = page_record(r.page_id, r.url, (r.html or "").encode()[:record_bytes], None, date)
        held += len(record)
        if held > sample_bytes:
            break
        sample.append(record)
    return sample


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 0, sample_records: int = 2000,
                   sample_bytes: int = 8 << 20, record_bytes: int = 16 << 10, file_bytes: int = 512 << 20, level: int = 3,
                   date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; returns (path, records) of the files.

    ``sample_records``, ``sample_bytes`` and ``record_bytes`` bound what the
    dictionary is built from; a file is closed at ``file_bytes`` compressed bytes."""
    n = pages.count()
    if n == 0:
        return pages.sparkSession.createDataFrame([], "path string, records long")
    dictionary = train_dictionary(dictionary_sample(pages, n, sample_records, sample_bytes, record_bytes, date))

    def save(batches):
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if own is not None:
            own.precompute_compress(level=level)
        compress = zstandard.ZstdCompressor(level=level, dict_data=own).compress
        opened, records, size = None, 0, 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if opened is None:
                    opened, records = new_file(folder, "pages", ".warc.zst"), 0
                    out, uri = opened.__enter__()
                    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                    out.write(compress(warc_record("warcinfo", [
                        ("WARC-Record-ID", "<urn:info:0>"), ("WARC-Date", date),
                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
                    size = 0
                frame = compress(page_record(page_id, url, payload, refers_to, date))
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= file_bytes:
                    opened.__exit__(None, None, None)
                    opened = None
                    yield pa.RecordBatch.from_pydict({"path": [uri], "records": pa.array([records], pa.int64())})
        if opened is not None:
            opened.__exit__(None, None, None)
            yield pa.RecordBatch.from_pydict({"path": [uri], "records": pa.array([records], pa.int64())})

    return materialize(plan_revisits(pages, min_revisit).mapInArrow(save, "path string, records long"), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of
    all page records.  A response's digest is computed from its payload and
    must equal its header; a revisit has those of the response."""
    rows = [(r.path,) for r in files.select("path").collect()]
    listed = spark.createDataFrame(rows, "path string")
    if rows:
        listed = listed.repartition(len(rows))

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def scan(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def batch_of(got):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                got: list = []
                with random_access(path) as f:
                    for data in frames(f)[1]:
                        headers, block = parse_record(data)
                        kind = headers["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        at = block.index(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", block[:at])[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (len(block) - at - 4 != size or base32_sha1(block[at + 4:]) != digest):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                        refers = headers.get("WARC-Refers-To")
                        got.append((page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], size, digest, kind,
                                    page_of(refers) if refers else None))
                        if len(got) == 5000:
                            yield batch_of(got)
                            got = []
                if got:
                    yield batch_of(got)

    return listed.mapInArrow(scan, schema)


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    files = write_archives(pages, scratch_path(spark, "archives"))
    return read_archives(spark, files).drop("url")
