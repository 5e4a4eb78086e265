"""Substring deduplication by level-wise doubling (operator 13).

A window is a run of ``n`` words of one document.  Levels have the lengths
``ceil(n / 2)``, ``n``, ``2n``, ``4n``, ...; only what is repeated at one
length is extended to the next:

* half level: two half windows that overlap by a word at most make a window,
  so each window names the half window with the smallest hash in it as its
  anchor.  Equal windows have equal anchors: where the anchor is not repeated,
  no window around it is.
* level ``n``: windows around repeated anchors.  The smallest doc_id that
  holds a window decides which documents lose it.
* levels above: a window of twice the length is two repeated windows, one after
  the other.  The loop ends when no candidate survives; ``longest`` is the
  length of the last level at which a document still shared a window.

The documents are stored once in blocks of some MB, as a table bucketed by
block.  In every level a block sends each of its distinct hashes once, sorted
and packed by bucket of the hash, whatever number of its documents hold it;
the task of a bucket answers with bits in the same order (``exchange``), and
the bits go back to the blocks, which join them without moving the texts.
So a window that a third of all documents hold is one entry per block.

Words are runs of characters other than 0x20 and 0x09-0x0D, unchanged.  Hashes
have 64 bits and the bucket's bits of another hash.  A null, empty or blank
text and a text of fewer than ``n`` words keep all they have.  A row without
doc_id has no smaller one: it loses nothing, and nothing is lost for it.  Rows
of one doc_id lose nothing to each other.  A document of any length stays in
one block.  An empty table gives no rows.  Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import (arrow_map, delete_path, discard, input_bytes, materialize, mix64, release, split_words,
                     tasks_for, word_hashes)

BLOCK_SCHEMA = "block long, ids array<long>, texts array<string>"
ENTRY_SCHEMA = "block long, bucket int, keys binary, low binary, multi binary"
STATE_SCHEMA = "block long, ends binary, ranks binary, low binary, pos binary, keys binary, longest array<long>"
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# --- packing -----------------------------------------------------------------

def planes(values: np.ndarray) -> bytes:
    """Integers byte by byte (all first bytes, all second ones, ...), so that
    the zeros of small numbers compress away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


# --- hashes and entries of a block ---------------------------------------------

def run_hashes(h: np.ndarray, n: int, factor: np.uint64) -> np.ndarray:
    """Hash of the ``n`` values from each place on (places with fewer are left out)."""
    size = max(len(h) - n + 1, 0)
    acc = np.full(size, n, np.uint64)
    for j in range(n if size else 0):
        acc *= factor
        acc += h[j:j + size]
    return mix64(acc)


class Entries:
    """The distinct (bucket, key) of a block, in that order.

    ``of`` is the entry of each occurrence, ``low`` the smallest document rank
    that holds an entry and ``multi`` whether another one does too.
    Occurrences come in ascending rank."""

    def __init__(self, bucket: np.ndarray, key: np.ndarray, rank: np.ndarray):
        order = np.argsort(key, kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        b, k, r = bucket[order], key[order], rank[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        self.of = np.empty(len(k), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.bucket, self.key, self.low = b[first], k[first], r[first]
        self.multi = r[np.append(first[1:], len(k))[:len(first)] - 1] != self.low

    def rows(self, block: int, ids: np.ndarray | None) -> pa.RecordBatch:
        """One row per bucket; ``ids`` gives the doc_id of a rank (None: the
        keys travel alone)."""
        cuts = np.flatnonzero(np.diff(self.bucket, prepend=-1)) if len(self.bucket) else np.empty(0, np.int64)
        parts = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(self.bucket)]))
        alone = ids is None
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block] * len(parts), pa.int64()),
            "bucket": pa.array(self.bucket[cuts], pa.int32()),
            "keys": pa.array([self.key[a:b].tobytes() for a, b in parts], pa.binary()),
            "low": pa.array([None if alone else planes(ids[self.low[a:b]]) for a, b in parts], pa.binary()),
            "multi": pa.array([None if alone else bits(self.multi[a:b]) for a, b in parts], pa.binary())})

    def answers(self, found: list | None) -> tuple[np.ndarray, np.ndarray]:
        """(an earlier document elsewhere holds it, two documents hold it) by entry."""
        earlier, many = np.zeros(len(self.key), bool), self.multi.copy()
        starts = np.searchsorted(self.bucket, [f["bucket"] for f in found or []])
        ends = np.searchsorted(self.bucket, [f["bucket"] for f in found or []], "right")
        for f, a, b in zip(found or [], starts, ends):
            got = from_bits(f["bits"], 2 * (b - a))
            earlier[a:b] = got[:b - a]
            many[a:b] |= got[b - a:]
        return earlier, many


class BlockWords:
    """Words of a block's documents and what the levels need of them."""

    def __init__(self, ids: pa.Array, texts: pa.Array, n: int, buckets: int):
        self.n, self.buckets = n, buckets
        self.counts, self.number, self.words = split_words(texts)
        self.ends = np.cumsum(self.counts)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        value = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.ids, self.ranks = np.unique(value, return_inverse=True)  # rows come in order of id, nulls last
        h = word_hashes(self.words)[self.number] if len(self.number) else np.empty(0, np.uint64)
        self.h = h
        left = np.repeat(np.where(known, self.ends, 0), self.counts) - np.arange(len(h))
        self.starts = np.flatnonzero(left >= n)
        self.rank = np.repeat(self.ranks, self.counts)

    def anchors(self) -> tuple[Entries, np.ndarray]:
        """Entries of the anchors, and the anchor's entry by window."""
        half = -(-self.n // 2)
        g = run_hashes(self.h, half, FIRST)
        place = self.starts
        best = g[place] if len(place) else np.empty(0, np.uint64)
        for j in range(1, self.n - half + 1):
            other = g[self.starts + j]
            better = other < best
            best = np.where(better, other, best)
            place = np.where(better, self.starts + j, place)
        places, which = np.unique(place, return_inverse=True)
        g = g[places] if len(places) else best
        entries = Entries((g >> np.uint64(32)).astype(np.int64) % self.buckets, g.astype(np.uint32), self.rank[places])
        return entries, entries.of[which]

    def windows(self, found: list | None) -> tuple[np.ndarray, np.ndarray, Entries]:
        """Starts of the windows around repeated anchors, their hashes, their entries."""
        entries, of = self.anchors()
        starts = self.starts[entries.answers(found)[1][of]]
        key = run_hashes(self.h, self.n, FIRST)[starts] if len(starts) else np.empty(0, np.uint64)
        bucket = run_hashes(self.h, self.n, SECOND)[starts] if len(starts) else key
        return starts, key, Entries((bucket % np.uint64(self.buckets)).astype(np.int64), key, self.rank[starts])


# --- Spark -----------------------------------------------------------------------

def exchange(rows: DataFrame, buckets: int, width: int) -> DataFrame:
    """The answers to the entries of all blocks: (block, found), ``found`` a
    list of (bucket, bits) with two bits an entry, earlier ones first.  A task
    holds the entries of one bucket."""
    kind = f"<u{width}"

    def answer(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            keys = np.concatenate([np.frombuffer(r["keys"], kind) for r in rows])
            sizes = [len(r["keys"]) // width for r in rows]
            order = np.argsort(keys, kind="stable")
            new = np.ones(len(keys), bool)
            new[1:] = keys[order][1:] != keys[order][:-1]
            first = np.flatnonzero(new)
            group = np.empty(len(keys), np.int64)
            group[order] = np.cumsum(new) - 1
            if rows[0]["low"] is None:
                earlier, many = np.zeros(len(keys), bool), np.diff(first, append=len(keys)) > 1
            else:
                low = np.concatenate([from_planes(r["low"], "<i8") for r in rows])
                multi = np.concatenate([from_bits(r["multi"], s) for r, s in zip(rows, sizes)])
                least = np.minimum.reduceat(low[order], first)
                many = (np.maximum.reduceat(low[order], first) != least) | np.logical_or.reduceat(multi[order], first)
                earlier = least[group] < low
            many = many[group]
            at = 0
            for r, s in zip(rows, sizes):
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([r["block"]], pa.int64()), "bucket": pa.array([r["bucket"]], pa.int32()),
                    "bits": [bits(np.concatenate((earlier[at:at + s], many[at:at + s])))]})
                at += s
        release()

    return (rows.repartitionById(buckets, F.col("bucket")).mapInArrow(answer, "block long, bucket int, bits binary")
            .repartition(buckets, "block").groupBy("block")
            .agg(F.collect_list(F.struct("bucket", "bits")).alias("found")))


def blocked(docs: DataFrame, buckets: int) -> tuple[DataFrame, str, str]:
    """``docs`` in blocks (one Arrow batch each), rows in order of doc_id, as a
    table bucketed by block: (table, its name, its path)."""
    number = [0]

    def run(batch: pa.RecordBatch) -> dict:
        from pyspark import TaskContext
        import pyarrow.compute as pc
        batch = batch.take(pc.sort_indices(batch, [("doc_id", "ascending")], null_placement="at_end"))
        number[0] += 1
        return {"block": [(TaskContext.get().partitionId() << 32) + number[0]],
                **{name: pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(source))
                   for name, source in (("ids", "doc_id"), ("texts", "text"))}}

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    name, path = f"blocks_{uuid.uuid4().hex[:12]}", scratch_path(spark, "text-blocks")
    (arrow_map(rows, run, BLOCK_SCHEMA).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, "block").sortBy("block").saveAsTable(name))
    return spark.table(name), name, path


def _each(fn, schema: str):
    """``mapInArrow`` function that gives ``fn`` a row as (scalars by name) and
    yields the batches it returns."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield fn({name: batch.column(name)[i] for name in batch.schema.names})
        release()
    return run, schema


def spans(removed: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of marked words, cut at the ends of documents: (first, end)."""
    inside = np.diff(removed.astype(np.int8), prepend=0, append=0)
    cut = ends[(ends > 0) & (ends < len(removed))]
    cut = np.unique(cut[removed[cut - 1] & removed[cut]]) if len(cut) else cut
    return (np.sort(np.concatenate((np.flatnonzero(inside == 1), cut))),
            np.sort(np.concatenate((np.flatnonzero(inside == -1), cut))))


def deduplicate(docs: DataFrame, n: int = 13, texts: bool = True) -> DataFrame:
    """Every document without the words covered by a window of ``n`` words that
    also starts in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, spans (first word, word after the
    last), longest, kept_sha256 and, with ``texts``, kept: the words left,
    joined by one space.  Windows are judged on the input."""
    if n < 2:
        raise ValueError("a window needs two words or more")
    spark = docs.sparkSession
    buckets = tasks_for(spark, input_bytes(docs))
    blocks, name, path = blocked(docs, buckets)

    def half(r):
        words = BlockWords(r["ids"].values, r["texts"].values, n, buckets)
        return words.anchors()[0].rows(r["block"].as_py(), None)

    def full(r):
        words = BlockWords(r["ids"].values, r["texts"].values, n, buckets)
        return words.windows(r["half"].as_py())[2].rows(r["block"].as_py(), words.ids)

    def finish(r):
        words = BlockWords(r["ids"].values, r["texts"].values, n, buckets)
        starts, key, entries = words.windows(r["half"].as_py())
        earlier, many = entries.answers(r["found"].as_py())
        lost = starts[earlier[entries.of] | (words.rank[starts] > entries.low[entries.of])]
        edge = np.zeros(len(words.h) + 1, np.int32)
        np.add.at(edge, lost, 1)
        np.add.at(edge, lost + n, -1)
        removed = np.cumsum(edge)[:-1] > 0
        first, end = spans(removed, words.ends)
        bounds = np.concatenate(([0], words.ends))
        lost_by_doc = np.diff(np.concatenate(([0], np.cumsum(removed)))[bounds])
        doc = np.searchsorted(words.ends, first, "right")
        per_doc = np.bincount(doc, minlength=len(words.counts))
        pairs = pa.StructArray.from_arrays([pa.array(first - bounds[doc], pa.int64()),
                                            pa.array(end - bounds[doc], pa.int64())], ["first", "end"])
        kept, digests = [], []
        stay = np.flatnonzero(~removed)
        at = np.searchsorted(stay, bounds)
        for a, b in zip(at.tolist(), at[1:].tolist()):
            data = b" ".join([words.words[k] for k in words.number[stay[a:b]].tolist()])
            digests.append(hashlib.sha256(data).hexdigest())
            kept.append(data if texts else None)
        again = many[entries.of]
        whole = pa.array([0, len(words.counts)], pa.int32())
        lists = {"ids": r["ids"].values, "n_words": pa.array(words.counts, pa.int64()),
                 "n_removed": pa.array(lost_by_doc, pa.int64()),
                 "spans": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_doc))), pa.int32()), pairs),
                 "kept_sha256": pa.array(digests, pa.string()),
                 "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                 "longest": pa.array(np.where(np.bincount(
                     np.searchsorted(words.ends, starts[again], "right"), minlength=len(words.counts)) > 0, n, 0), pa.int64())}
        state = {"ends": words.ends.astype("<i8").tobytes(), "ranks": words.ranks.astype("<i8").tobytes(),
                 "low": words.ids.astype("<i8").tobytes(), "pos": starts[again].astype("<u4").tobytes(),
                 "keys": key[again].tobytes()}
        return pa.RecordBatch.from_pydict(
            {"block": [r["block"].as_py()], **{c: pa.ListArray.from_arrays(whole, v) for c, v in lists.items()},
             **{c: [v] for c, v in state.items()}})

    halves = materialize(exchange(blocks.mapInArrow(*_each(half, ENTRY_SCHEMA)), buckets, 4), "half-windows")
    halves = halves.withColumnRenamed("found", "half")
    ready = blocks.join(halves.hint("shuffle_hash"), "block", "left")
    found = materialize(exchange(ready.mapInArrow(*_each(full, ENTRY_SCHEMA)), buckets, 8), "windows")
    done = materialize(ready.join(found.hint("shuffle_hash"), "block", "left").mapInArrow(*_each(
        finish, "block long, ids array<long>, n_words array<long>, n_removed array<long>, "
                "spans array<array<struct<first: long, end: long>>>, kept_sha256 array<string>, kept array<string>, "
                "longest array<long>, ends binary, ranks binary, low binary, pos binary, keys binary")), "deduplicated")
    spark.sql(f"DROP TABLE {name}")
    for table in (halves, found):
        discard(table)
    delete_path(spark, path)

    longest = longest_windows(done.select(*(c.split()[0] for c in STATE_SCHEMA.split(", "))), n, buckets)
    columns = ["ids", "n_words", "n_removed", "spans", "kept_sha256", *(["kept"] if texts else []), "longest"]
    rows = done.drop("longest").join(longest.hint("shuffle_hash"), "block")
    return (rows.select(F.explode(F.arrays_zip(*columns)).alias("d"))
            .select(F.col("d.ids").alias("doc_id"), *(f"d.{c}" for c in columns[1:])))


def longest_windows(state: DataFrame, n: int, buckets: int) -> DataFrame:
    """Doubles the length of the repeated windows of ``state`` until none is
    repeated: (block, longest by document)."""
    def double(r, length):
        """Entries of the windows of twice the length that may be repeated,
        their places and hashes, and each window's document."""
        pos = np.frombuffer(r["pos"].as_py(), "<u4").astype(np.int64)
        key = np.frombuffer(r["keys"].as_py(), "<u8")
        doc = np.searchsorted(np.frombuffer(r["ends"].as_py(), "<i8"), pos, "right")
        then = np.searchsorted(pos, pos + length)
        ok = then < len(pos)
        ok[ok] = (pos[then[ok]] == pos[ok] + length) & (doc[then[ok]] == doc[ok])
        a, b = key[ok], key[then[ok]]
        bucket = (mix64(a * SECOND + b) % np.uint64(buckets)).astype(np.int64)
        pos, doc, key = pos[ok], doc[ok], mix64(a * FIRST + b)
        return Entries(bucket, key, np.frombuffer(r["ranks"].as_py(), "<i8")[doc]), pos, key, doc

    def emit(length):
        return _each(lambda r: double(r, length)[0].rows(
            r["block"].as_py(), np.frombuffer(r["low"].as_py(), "<i8")), ENTRY_SCHEMA)

    def settle(length):
        def run(r):
            entries, pos, key, doc = double(r, length)
            again = entries.answers(r["found"].as_py())[1][entries.of]
            longest = r["longest"].values.to_numpy().copy()
            longest[doc[again]] = 2 * length
            return pa.RecordBatch.from_pydict({
                **{c: [r[c].as_py()] for c in ("block", "ends", "ranks", "low")},
                "pos": [pos[again].astype("<u4").tobytes()], "keys": [key[again].tobytes()], "longest": [longest]})
        return _each(run, STATE_SCHEMA)

    length, before = n, None
    while state.agg(F.sum(F.octet_length("pos"))).first()[0]:
        found = exchange(state.mapInArrow(*emit(length)), buckets, 8)
        state = materialize(state.join(found.hint("shuffle_hash"), "block", "left").mapInArrow(*settle(length)),
                            "longer-windows")
        if before is not None:
            discard(before)
        before, length = state, 2 * length
    return state.select("block", "longest")


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return deduplicate(docs, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256", "longest")
