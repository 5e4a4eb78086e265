"""Token ids in fixed-width bit-packed files (operator 9).

Each id takes the minimum number of bits that holds every id of the
vocabulary.  A file is a run of blocks followed by an index:

    magic | block 0 | block 1 | ... | footer | footer length (8 bytes)

A block packs ``block_tokens`` ids (the last one fewer), least significant
bit first, padded to a byte.  The footer holds the offsets of the blocks, the
document ids (with null flags) and the first token of each document, so a
reader fetches only the blocks that overlap a range and unpacks them with
numpy.

``write`` orders documents by (doc_id, ids), nulls first: tasks own ranges of
ids, so the files' order is the order of their ranges.  Repeated rows are
kept, each as a document of its own; a null or empty text has only the end
id; an empty table gives no file.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import arrow_map, input_bytes, materialize, tasks_for
from .files import new_file, random_access
from .tokens import chunk_encoder, vocabulary_size

MAGIC = b"BITIDS01"


def bit_width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary`` (1 at least)."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids packed at ``bits`` bits each, least significant bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) and bits < 32 and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):  # whole bytes: the same layout
        return ids.astype(f"<u{bits // 8}").tobytes()
    cells = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(cells.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    cells = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = cells
    return np.packbits(full, axis=1, bitorder="little").reshape(-1).view("<u4").astype(np.uint32)


class BlockWriter:
    """Streams documents into one file; memory holds one block and the index."""

    def __init__(self, out, bits: int, block_tokens: int):
        self.out, self.bits, self.block = out, bits, block_tokens
        self.rest: list[np.ndarray] = []
        self.held = self.tokens = 0
        self.offsets, self.ids, self.nulls, self.starts = [len(MAGIC)], [], [], [0]
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.tokens += len(ids)
        self.starts.append(self.tokens)
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= 16 * self.block:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.empty(0, np.uint32)
        stop = len(ids) if last else len(ids) // self.block * self.block
        for a in range(0, stop, self.block):
            data = pack(ids[a:min(a + self.block, stop)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.rest, self.held = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self.flush(True)
        head = json.dumps({"bits": self.bits, "block_tokens": self.block, "tokens": self.tokens,
                           "docs": len(self.ids), "blocks": len(self.offsets) - 1}).encode()
        body = (struct.pack("<I", len(head)) + head + np.array(self.offsets, "<i8").tobytes()
                + np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes()
                + np.array(self.starts, "<i8").tobytes())
        self.out.write(body)
        self.out.write(struct.pack("<q", len(body)))


class BlockReader:
    """Random access to one file."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        body_len, = struct.unpack("<q", f.read_at(8, size - 8))
        body = f.read_at(body_len, size - 8 - body_len)
        n, = struct.unpack_from("<I", body)
        self.head = json.loads(body[4:4 + n])
        at = 4 + n
        docs, blocks = self.head["docs"], self.head["blocks"]
        self.offsets = np.frombuffer(body, "<i8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.ids = np.frombuffer(body, "<i8", docs, at)
        at += 8 * docs
        self.nulls = np.frombuffer(body, "u1", docs, at).astype(bool)
        self.starts = np.frombuffer(body, "<i8", docs + 1, at + docs)

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b`` (exclusive), reading only the blocks they lie in."""
        if a >= b:
            return np.empty(0, np.uint32)
        size, bits = self.head["block_tokens"], self.head["bits"]
        first, last = a // size, (b - 1) // size
        lo = int(self.offsets[first])
        data = self.f.read_at(int(self.offsets[last + 1]) - lo, lo)
        out = [unpack(data[int(self.offsets[k]) - lo:int(self.offsets[k + 1]) - lo],
                      min(size, self.head["tokens"] - k * size), bits) for k in range(first, last + 1)]
        return np.concatenate(out)[a - first * size:b - first * size]

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = 1, text: str = "text") -> DataFrame:
    """Adds ``ids``: the text's ids (uint32, little-endian) and the end id."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batch: pa.RecordBatch) -> dict:
        ids, counts = chunk_encoder(tokenizer).encode(batch.column(text))
        ends = np.cumsum(counts)
        at = np.repeat(ends, len(tail))
        ids = np.insert(ids, at, np.tile(tail, len(counts))) if len(tail) else ids
        ends = (ends + len(tail) * np.arange(1, len(counts) + 1)) * 4
        offs = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes())
        packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, offs, pa.py_buffer(ids.tobytes())])
        return {"doc_id": batch.column("doc_id"), "ids": packed}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), text), run, "doc_id long, ids binary", text)


def write(tokens: DataFrame, folder: str, vocabulary: int, cuts: list[int], partitions: int,
          block_tokens: int = 8192) -> DataFrame:
    """Write (doc_id, ids) in ascending doc_id order as packed files.

    ``cuts`` are ascending doc_ids: a row belongs to range ``number of cuts <=
    doc_id``.  Returns one row per file: range, path, docs, tokens."""
    bits = bit_width(vocabulary)

    def pack_ids(batch: pa.RecordBatch) -> dict:
        ids = batch.column("doc_id").to_pylist()
        return {"part": [0 if i is None else bisect_right(cuts, i) for i in ids],
                "doc_id": batch.column("doc_id"),
                "n": [len(x) // 4 for x in batch.column("ids").to_pylist()],
                "packed": [pack(np.frombuffer(x, "<u4"), bits) for x in batch.column("ids").to_pylist()]}

    def save(batches):
        opened = writer = None
        part = 0
        for batch in batches:
            for p, doc_id, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    part = p
                    opened = new_file(folder, f"ids-{part:06d}", ".bits")
                    out, uri = opened.__enter__()
                    writer = BlockWriter(out, bits, block_tokens)
                writer.add(doc_id, unpack(data, n, bits))
        if writer is not None:
            writer.close()
            opened.__exit__(None, None, None)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [uri], "docs": pa.array([len(writer.ids)], pa.int64()),
                 "tokens": pa.array([writer.tokens], pa.int64())})

    rows = (arrow_map(tokens, pack_ids, "part int, doc_id long, n int, packed binary", "ids")
            .repartitionById(partitions, F.col("part"))
            .sortWithinPartitions("part", "doc_id", "packed"))
    return materialize(rows.mapInArrow(save, "part int, path string, docs long, tokens long"), "bit-files")


def read_documents(spark: SparkSession, files: DataFrame, step_tokens: int = 1 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of
    ``write``; ``start`` counts the ids before it over all files.  The driver
    holds one row per file."""
    rows, start = [], 0
    for f in sorted(files.collect(), key=lambda r: r.part):
        rows.append((f.path, start))
        start += f.tokens
    listed = spark.createDataFrame(rows, "path string, start long")
    if rows:
        listed = listed.repartition(len(rows))

    def scan(batches):
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with random_access(path) as f:
                    r = BlockReader(f)
                    s, k = r.starts, 0
                    while k < len(r.ids):
                        # whole documents of about step_tokens ids
                        stop = max(k + 1, int(np.searchsorted(s, s[k] + step_tokens, "right")) - 1)
                        ids, lo = r.tokens(int(s[k]), int(s[stop])).astype("<u4"), int(s[k])
                        view = memoryview(ids.tobytes())
                        crc = [zlib.crc32(view[4 * (int(s[i]) - lo):4 * (int(s[i + 1]) - lo)])
                               for i in range(k, stop)]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(r.ids[k:stop], pa.int64(), mask=r.nulls[k:stop]),
                            "start": pa.array(s[k:stop] + start, pa.int64()),
                            "n_tokens": pa.array(np.diff(s[k:stop + 1]), pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64())})
                        k = stop

    return listed.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def range_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """Ascending values that cut ``column`` into about ``parts`` even ranges
    (a distributed quantile sketch; only the cuts reach the driver)."""
    if parts < 2:
        return []
    q = df.select(F.col(column).cast("double").alias("q")).approxQuantile(
        "q", [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted({int(x) for x in q})


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, block_tokens: int = 8192,
                folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them; returns the file list."""
    spark = docs.sparkSession
    parts = tasks_for(spark, input_bytes(docs))
    cuts = range_cuts(docs, "doc_id", parts)
    folder = folder or scratch_path(spark, "token-files")
    return write(encode(docs, tokenizer, end_id), folder, vocabulary_size(tokenizer), cuts, parts, block_tokens)


def op9(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_documents(spark, token_files(docs, tokenizer))
