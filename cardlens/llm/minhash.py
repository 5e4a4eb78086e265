"""MinHash fingerprints (operator 6).

A document's shingles (runs of five words, A-Z lower-cased; the whole sequence
of a shorter text) are hashed to 64 bits; ``PERMUTATIONS`` universal hashes
``a * x + b`` of them are minimised in vectorised numpy.  A fingerprint is the
hex string of 16 bits of each minimum; the share of equal positions estimates
the Jaccard similarity of the shingle sets.  A null text counts as empty; texts
without words have the fingerprint of the empty set, which is like itself (1)
and unlike any other (0).

``near_duplicates`` joins bands of the signatures in Spark and verifies the
Jaccard similarity of the shingle sets themselves.

Neighbours are taken in descending doc_id (rows without id come last; equal
ids in order of their text), the first document following the last one.  Each
task owns a range of ids; the one document that the range before it needs is
sent there too, so no task sees more than its range.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitpack import range_cuts
from .common import (arrow_map, input_bytes, materialize, mix64, shingle_hashes, shingle_sets, slices,
                     tasks_for)
from .jaccard import block_units, linked_pairs, to_list

PERMUTATIONS = 128
SHINGLE = 5


@lru_cache(maxsize=4)
def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the ``n`` permutations of 64-bit values."""
    seeds = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return seeds[:n] | np.uint64(1), seeds[n:]


def signatures(hashes: np.ndarray, counts: np.ndarray, n: int = PERMUTATIONS, block: int = 1 << 15) -> np.ndarray:
    """Minima by text and permutation, cut to 16 bits; texts without shingles
    have 0 everywhere, minima never do."""
    out = np.zeros((len(counts), n), np.uint16)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    a, b = coefficients(n)
    ends = np.cumsum(counts[full])
    starts = ends - counts[full]
    k = 0
    while k < len(full):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + block, "right")))
        x = hashes[starts[k]:ends[stop - 1]]
        cut, buffer = starts[k:stop] - starts[k], np.empty_like(x)
        low = np.empty((n, stop - k), np.uint64)
        for i in range(n):
            np.multiply(x, a[i], out=buffer)
            np.add(buffer, b[i], out=buffer)
            low[i] = np.minimum.reduceat(buffer, cut)
        out[full[k:stop]] = np.maximum((mix64(low) & np.uint64(0xFFFF)).T, 1)
        k = stop
    return out


def text_signatures(column: pa.Array) -> np.ndarray:
    return signatures(*shingle_hashes(column, SHINGLE))


def hex_strings(sigs: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in sigs.astype(">u2")]


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of whole texts."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "fingerprint": hex_strings(text_signatures(batch.column(text)))}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), text), run, "doc_id long, fingerprint string", text)


def with_successor(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows sorted by descending doc_id within ranges: (part, guest, doc_id,
    text), each range followed by the next range's first row as a guest."""
    spark = docs.sparkSession
    parts = tasks_for(spark, input_bytes(docs))
    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    cuts = [float(c) for c in range_cuts(rows, "doc_id", parts)]
    order = F.coalesce(F.col("doc_id"), F.lit(-2**63)).cast("double")

    def placed(df: DataFrame) -> DataFrame:
        if not cuts:
            return df.withColumn("part", F.lit(0))
        split = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="__at", outputCol="__part")
        return split.transform(df.withColumn("__at", order)).withColumn("part", F.col("__part").cast("int"))

    # one row per range: its greatest id, and the range that needs it
    tops = sorted((r.part, r.top) for r in placed(rows.select("doc_id")).groupBy("part")
                  .agg(F.max(F.coalesce("doc_id", F.lit(-2**63))).alias("top")).collect())
    guests = spark.createDataFrame([(p, top, tops[(k + 1) % len(tops)][0]) for k, (p, top) in enumerate(tops)],
                                   "part int, top long, guest_of int")
    is_top = F.coalesce("doc_id", F.lit(-2**63)) == F.col("top")
    places = F.when(is_top, F.array(F.struct("part", F.lit(False).alias("guest")),
                                    F.struct(F.col("guest_of").alias("part"), F.lit(True).alias("guest")))
                    ).otherwise(F.array(F.struct("part", F.lit(False).alias("guest"))))
    # ``guests`` has one row per shuffle partition
    dealt = (placed(rows).join(F.broadcast(guests), "part")
             .select(F.explode(places).alias("place"), "doc_id", "text").select("place.part", "place.guest", "doc_id", "text"))
    return (dealt.repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_edited(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each text, its edited text (the last half replaced by the start of the
    next document) and the likeness of their fingerprints."""

    def rows_of(ids: list, texts: list[str], sigs: np.ndarray) -> pa.RecordBatch:
        """All rows but the last one, which only is a successor."""
        edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(texts, texts[1:])]
        mixed = text_signatures(pa.array(edited, pa.string()))
        own, following = sigs[:-1], sigs[1:]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids[:-1], pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited],
            "fingerprint": hex_strings(own), "edited_fingerprint": hex_strings(mixed),
            "near_edited": (own == mixed).mean(axis=1), "near_next": (own == following).mean(axis=1)})

    def run(batches):
        ids: list = []
        texts: list = []
        sigs = np.empty((0, PERMUTATIONS), np.uint16)
        ended = False
        for batch in batches:
            for part in slices(batch, "text"):
                guest = part.column("guest").to_pylist()
                n = guest.index(True) + 1 if True in guest else len(guest)
                if ended or n == 0:
                    continue
                ended = True in guest  # further guests have the same id
                part = part.slice(0, n)
                ids += part.column("doc_id").to_pylist()
                texts += [t or "" for t in part.column("text").to_pylist()]
                sigs = np.concatenate((sigs, text_signatures(part.column("text"))))
                if len(ids) > 1:
                    yield rows_of(ids, texts, sigs)
                ids, texts, sigs = ids[-1:], texts[-1:], sigs[-1:]

    return with_successor(docs, text).mapInArrow(run, EDITED)


def near_duplicates(docs: DataFrame, threshold: float = 0.75, rows_per_band: int = 4,
                    text: str = "text", block_docs: int = 1024, block_tokens: int = 4 << 20) -> DataFrame:
    """(doc_id, other_id, jaccard): links that hold groups of near copies
    together.

    Texts with equal shingle sets are represented by their smallest id.  The
    representatives that share a band of the signature form a bucket (buckets
    of the same members count once).  A bucket is searched like a branch of
    operator 10: large ones in pairs of blocks, and every pair that can reach
    ``threshold`` is verified on the shingle sets unless earlier links of the
    unit connect it already.  So all documents that links within buckets
    connect are connected, whatever else a bucket holds; two documents that
    share no band are not compared.  Rows without doc_id and texts without
    words are left out; an empty table gives no rows."""
    bands = PERMUTATIONS // rows_per_band
    least = Fraction(str(threshold))
    parts = tasks_for(docs.sparkSession, 4 * input_bytes(docs))

    def keys_of(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        ends = np.cumsum(sizes)
        return [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends - sizes, ends)]

    def sign(batch: pa.RecordBatch) -> dict:
        column = batch.column("text")
        sigs = text_signatures(column)
        sets, sizes = shingle_sets(column, SHINGLE)
        keys = np.zeros((len(sigs), bands), np.uint64)
        for j in range(rows_per_band):
            keys = mix64(keys ^ sigs[:, j:bands * rows_per_band:rows_per_band].astype(np.uint64))
        return {"doc_id": batch.column("doc_id"), "n": sizes, "set_key": keys_of(sets, sizes),
                "bands": list(keys.view(np.int64))}

    def expand(batch: pa.RecordBatch) -> dict:
        sets, sizes = shingle_sets(batch.column("text"), SHINGLE)
        return {"doc_id": batch.column("doc_id"), "set_key": keys_of(sets, sizes), "set": to_list(sets, sizes)}

    def search(batches):
        held, sides = None, ([], [])

        def done():
            entries = sides[0] + sides[1]
            numbered = [(k, s) for k, (_, s) in enumerate(entries)]
            cut = len(sides[0])
            if not cut or len(entries) < 2:
                return
            found = linked_pairs(numbered[:cut], numbered[cut:] or None, least)
            out: dict = {"doc_id": [], "other_id": [], "jaccard": []}
            for a, b in found:
                (i, x), (j, y) = entries[a], entries[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                for column, value in zip(out.values(), (max(i, j), min(i, j), both / (len(x) + len(y) - both))):
                    column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("doc_id", pa.int64()), ("other_id", pa.int64()), ("jaccard", pa.float64())]))

        for batch in batches:
            for unit, side, doc, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and unit != held:
                    yield from done()
                    sides = ([], [])
                held = unit
                sides[side].append((doc, np.frombuffer(data, "<u8")))
        yield from done()

    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).where("doc_id is not null")
    signed = materialize(arrow_map(rows, sign, "doc_id long, n long, set_key binary, bands array<long>", "text")
                         .where("n > 0"), "signatures")
    reps = materialize(signed.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                                     F.first("bands").alias("bands")), "representatives")
    same = signed.join(reps.select("set_key", "rep"), "set_key").where("doc_id != rep").select(
        "doc_id", F.col("rep").alias("other_id"), F.lit(1.0).alias("jaccard"))
    banded = reps.select("set_key", "n", F.posexplode("bands").alias("band", "key"))
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "set_key").cast("decimal(38,0)"))
    members = (banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m"), total(1).alias("s1"), total(2).alias("s2"))
               .where("m > 1"))
    buckets = (members.groupBy("m", "s1", "s2").agg(F.min(F.struct("band", "key")).alias("first"))
               .select("first.band", "first.key"))
    held = banded.join(buckets, ["band", "key"]).select("set_key", "n", F.xxhash64("band", "key").alias("component"))
    units = materialize(block_units(materialize(held, "buckets"), block_docs, block_tokens, "set_key", least),
                        "bucket-units")
    own = reps.join(units, "set_key", "left_semi").select("set_key", F.col("rep").alias("doc_id"))
    sets = (arrow_map(rows.join(own.select("doc_id"), "doc_id", "left_semi"), expand,
                      "doc_id long, set_key binary, set binary", "text")
            .join(own, ["set_key", "doc_id"], "left_semi").dropDuplicates(["set_key"]))
    linked = (units.join(materialize(sets, "bucket-sets"), "set_key").select("unit", "side", "doc_id", "set")
              .repartition(parts, "unit").sortWithinPartitions("unit", "side", "doc_id")
              .mapInArrow(search, "doc_id long, other_id long, jaccard double").where("doc_id != other_id").distinct())
    return linked.unionByName(same)


def op6(docs: DataFrame) -> DataFrame:
    return compare_edited(docs)
