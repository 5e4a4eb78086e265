"""Packing into optimal length buckets (operator 1).

The global histogram of document lengths goes to a dynamic program that
chooses at most ``buckets`` boundaries such that padding every document to
the next boundary adds the fewest tokens over all documents (exact optimum,
divide and conquer over the monotone split points).  Inside a bucket of
boundary L, batches hold ``max(1, token_budget // L)`` documents in an order
drawn from a hash of the id, so only the last batch of a bucket is short.

Documents without tokens (null or blank text) need no batch: bucket 0, null
batch.  A document longer than the budget is a batch of its own.  Repeated
rows are packed one by one, rows without doc_id like others of one id; an
empty table gives an empty result; other columns are ignored.  The driver
holds one row per distinct length, at most the longest length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize
from .tokens import chunk_encoder

#: Bytes of text whose tokens a task counts at a time: the encoder's table of
#: chunks lasts for the task, so that short slices cost no time.
SLICE = 1 << 20


def token_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of whole texts."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "n_tokens": chunk_encoder(tokenizer).counts(batch.column(text))}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), text), run, "doc_id long, n_tokens long", text, SLICE)


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending boundaries, the last one the greatest length, that minimise
    the padding ``sum(count * (boundary - length))`` with at most ``buckets``.

    ``lengths`` ascend.  Padding of lengths i..j in one bucket is
    ``lengths[j] * (C[j+1] - C[i]) - (S[j+1] - S[i])``; it satisfies the
    quadrangle inequality, so the best split points are monotone."""
    n = len(lengths)
    if n == 0:
        return []
    lengths = np.asarray(lengths, np.float64)
    c = np.concatenate(([0.0], np.cumsum(counts, dtype=np.float64)))
    best = lengths * c[1:]  # one bucket; the constant sum of lengths is left out
    splits = []
    for _ in range(min(buckets, n) - 1):
        prev, best = best, best.copy()
        split = np.zeros(n, np.int64)  # start of the last bucket; 0: one bucket only
        # level by level: all ranges of a level at once would need ragged
        # rows, so each middle point scans its range with numpy
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            mid = (lo + hi) // 2
            i = np.arange(max(a, 1), min(b, mid) + 1)
            at = a
            if len(i):
                cost = prev[i - 1] + lengths[mid] * (c[mid + 1] - c[i])
                k = int(cost.argmin())
                if cost[k] < best[mid]:
                    best[mid], split[mid] = cost[k], i[k]
                at = int(i[k])
            if lo < mid:
                todo.append((lo, mid - 1, a, at))
            if mid < hi:
                todo.append((mid + 1, hi, at, b))
        splits.append(split)
    out, j = [], n - 1
    for split in reversed(splits):
        out.append(int(lengths[j]))
        if split[j] == 0:
            return out[::-1]
        j = int(split[j]) - 1
    out.append(int(lengths[j]))
    return out[::-1]


def pack(lengths: DataFrame, buckets: int = 16, token_budget: int = 65_536, rows_per_shard: int = 50_000) -> DataFrame:
    """(doc_id, n_tokens) -> (doc_id, n_tokens, bucket_len, batch_id, position).

    Ranks inside a bucket come from shards (ranges of a hash of the id) of
    about ``rows_per_shard`` rows plus the shards' offsets, so no task holds
    a bucket; a batch may hold the end of one shard and the start of the next.
    """
    histogram = (lengths.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n"))
                 .orderBy("n_tokens").collect())
    values = np.array([r.n_tokens for r in histogram], np.int64)
    counts = np.array([r.n for r in histogram], np.int64)
    bounds = optimal_boundaries(values, counts, buckets)
    rows = np.add.reduceat(counts, np.searchsorted(values, [0, *bounds[:-1]], "right")) if bounds else []
    plan, first = [], 0
    for bound, n in zip(bounds, rows):
        size = max(1, token_budget // bound)
        plan.append((bound, max(1, -(-int(n) // rows_per_shard)), size, first))
        first += -(-int(n) // size)

    def pick(k: int, other):  # a value of the plan by the document's bucket
        col = F.lit(other)
        for row in reversed(plan):
            col = F.when(F.col("n_tokens") <= row[0], F.lit(row[k])).otherwise(col)
        return F.when(F.col("n_tokens") > 0, col)

    h = F.xxhash64("doc_id")
    share = F.shiftrightunsigned(h, 33) / F.lit(float(2**31))
    table = lengths.select(
        "doc_id", "n_tokens", F.coalesce(pick(0, 0), F.lit(0)).cast("long").alias("bucket_len"),
        pick(2, 1).cast("long").alias("__size"), pick(3, 0).cast("long").alias("__first"),
        F.floor(share * F.coalesce(pick(1, 1), F.lit(256))).cast("int").alias("__shard"),
        h.alias("__hash"))
    key = ["bucket_len", "__shard"]
    per_shard = table.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("bucket_len").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_shard.select(*key, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*key).orderBy("__hash", "doc_id", "n_tokens")
    rank = F.col("__offset") + F.col("__rank") - 1
    return (table.withColumn("__rank", F.row_number().over(inside)).join(offsets, key)
            .select("doc_id", "n_tokens", "bucket_len",
                    (F.col("__first") + F.floor(rank / F.col("__size"))).cast("long").alias("batch_id"),
                    F.when(F.col("bucket_len") > 0, F.pmod(rank, F.col("__size"))).cast("long").alias("position")))


def op1(docs: DataFrame, tokenizer: str, buckets: int = 16, token_budget: int = 65_536) -> DataFrame:
    lengths = materialize(token_lengths(docs, tokenizer), "token-lengths")
    return pack(lengths, buckets, token_budget)
