"""Exact n-gram Jaccard join with signature trees (operator 10).

A document's set holds its distinct 5-word shingles (A-Z lower-cased; fewer
words: the whole sequence).  Two documents link when the Jaccard similarity of
their sets reaches ``threshold``; linked sets of sizes a and b share at least
``threshold * max(a, b)`` tokens.  The search descends a tree whose nodes hold
OR-combined token bitmaps and size ranges, and drops a pair of nodes when its
greatest possible overlap is too small:

1. *Root.*  The bitmap of the whole corpus, kept in slices of the token space
   (one task each, as sparse bit positions), tells which tokens of a document
   any other set has.  A document whose greatest possible overlap with the
   rest is below what a link needs is dropped; equal sets go on as one.
2. *Branches.*  What remains is split along its rarest tokens: a document with
   n tokens needs a common token among its ``n - ceil(threshold * n) + 1``
   rarest ones, so documents that can link at all lie in one connected branch
   of the graph "has a common rare token".
3. *Trees.*  Each branch (or pair of blocks of a large branch, blocks of size
   classes that can link) is one unit: a tree of bitmaps and size ranges over
   its documents is traversed against itself or the other block's tree; the
   pairs that remain are verified on the sets, unless already connected.

No pair is dropped by anything but a bound, so no link is lost.  Tokens are
64-bit hashes of the shingles.  Null and empty texts, and texts of white space
only, have no tokens and link with nothing; a row without doc_id is left out;
rows with one doc_id count as one document with the union of their links.
Texts of any length are joined whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, input_bytes, materialize, mix64, ragged, released, shingle_sets, slices
from .graph import components

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
#: Text per chunk: the unit in which a task sends tokens to the slices.
CHUNK_BYTES = 4 << 20
#: Text that is cut into shingles at a time.
SLICE = 1 << 20
MANY = 0xFFFF


def to_list(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Runs of ``values``, ``counts`` long, as bytes."""
    data, size = values.tobytes(), values.itemsize
    ends = np.cumsum(counts) * size
    return [data[a:b] for a, b in zip((ends - counts * size).tolist(), ends.tolist())]


def squeeze(values: np.ndarray) -> bytes:
    """Byte planes of unsigned integers, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def chunk_sets(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of a chunk's texts.  Cutting texts takes several times
    the memory of the sets, so it is done by ``SLICE`` bytes."""
    parts = [shingle_sets(part.column("text"), SHINGLE) for part in slices(rows, "text", SLICE)]
    return np.concatenate([v for v, _ in parts]), np.concatenate([n for _, n in parts])


def set_keys(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set: equal for equal sets."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        ends = np.concatenate(([0], np.cumsum(mix64(values ^ np.uint64(salt)), dtype=np.uint64)))
        out.append(np.diff(ends[np.concatenate(([0], np.cumsum(counts)))]).view(np.int64))
    return out[0], out[1]


def slice_of(hashes: np.ndarray, slices_: int) -> np.ndarray:
    """The slice of the token space that a hash lies in (ascending)."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices_)) >> np.uint64(32)


def chunk_id(k: int) -> int:
    """A number of this task's k-th chunk that a second attempt finds again."""
    return (TaskContext.get().partitionId() << 24) + k


# --- root ------------------------------------------------------------------

ROOT = "at int, chunk long, a binary, b binary, c binary, d binary"


def root_candidates(docs: DataFrame, threshold: Fraction) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, possible): every document with the key of
    its set and the greatest possible overlap with any other set."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes(docs) / (16 << 20)))
    # enough hash bits that chance hits stay rare among about bytes / 2 tokens
    bits = min(56, max(36, int(input_bytes(docs) + 2).bit_length() + 12))
    shift = np.uint64(64 - bits)

    def send(batches):
        k = 0
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                for at in range(0, part.num_rows, MANY):
                    rows = part.slice(at, MANY)
                    yield from one_chunk(rows, chunk_id(k))
                    k += 1

    def one_chunk(rows, chunk):
        values, n = chunk_sets(rows)
        k1, k2 = set_keys(values, n)
        own = np.rec.fromarrays([k1, k2, n])
        _, first, back = np.unique(own, return_index=True, return_inverse=True)
        first = np.where(n > 0, first[back.ravel()], -1)  # the first equal set of the chunk
        own = first == np.arange(len(n))
        doc = np.repeat(np.flatnonzero(own).astype("<u2"), n[own])  # less than MANY rows
        # equal tokens adjoin
        key = values[np.repeat(own, n)]
        del values
        key >>= shift
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        del order
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        many = np.zeros(len(key), bool)
        many[:-1] |= ~new[1:]
        many |= ~new
        local = np.bincount(doc[many], minlength=len(n)).astype("<u4")
        token = key[new]
        who = np.where(many[new], MANY, doc[new]).astype("<u2")
        del key, doc, new, many
        out: dict = {c: [] for c in "at chunk a b c d".split()}

        def row(at, *blobs):
            for c, v in zip(out, (at, chunk, *blobs)):
                out[c].append(v)

        ids = rows.column("doc_id").to_numpy(zero_copy_only=False).astype("<i8")
        row(chunk % parts, b"", np.array([ids, n, k1, k2], "<i8").tobytes(), local.tobytes(), first.astype("<i4").tobytes())
        lane = slice_of(token << shift, parts).astype(np.int64)
        cuts = np.flatnonzero(np.diff(lane, prepend=-1, append=parts))
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                row(int(lane[a]), token[a:a + 1].astype("<u8").tobytes(),
                    squeeze(np.diff(token[a:b], prepend=token[a]).astype("<u8")), squeeze(who[a:b]), b"")
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("at", pa.int32()), ("chunk", pa.int64()), *((c, pa.binary()) for c in "abcd")]))

    def meet(batches):
        """One slice of the root bitmap: tokens of all chunks meet."""
        chunks, tokens, whos = [], [], []
        schema = pa.schema([("chunk", pa.int64()), *((c, pa.binary()) for c in "bcd")])
        for batch in batches:
            rows = batch.to_pydict()
            info = [k for k, a in enumerate(rows["a"]) if not a]
            if info:  # documents of a chunk pass through
                yield pa.RecordBatch.from_pydict({c: [rows[c][k] for k in info] for c in ("chunk", "b", "c", "d")},
                                                 schema=schema)
            for chunk, a, b, c in zip(rows["chunk"], rows["a"], rows["b"], rows["c"]):
                if a:
                    chunks.append(chunk)
                    tokens.append(np.cumsum(expand(b, "<u8")) + np.frombuffer(a, "<u8"))
                    whos.append(expand(c, "<u2"))
        if not tokens:
            return
        source = np.repeat(np.arange(len(chunks), dtype=np.int32), [len(t) for t in tokens])
        token = np.concatenate(tokens)
        del tokens
        who = np.concatenate(whos)
        del whos
        order = np.argsort(token)
        token = token[order]
        same = token[1:] == token[:-1]
        shared = np.zeros(len(token), bool)
        shared[1:] |= same
        shared[:-1] |= same
        del token, same
        order = order[shared]
        pair = source[order].astype(np.int64) * (MANY + 1)
        who = who[order]
        pair = (pair + who)[who != MANY]  # those were counted in their chunk
        del source, who, order, shared
        pair.sort()
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        pair, n = pair[start], np.diff(start, append=len(pair))
        at = pair // (MANY + 1)
        for k in range(0, len(chunks), 256):
            a, b = np.searchsorted(at, (k, k + 256))
            own = np.searchsorted(at[a:b], np.arange(k, min(k + 256, len(chunks)) + 1)) + a
            yield pa.RecordBatch.from_pydict({
                "chunk": chunks[k:k + 256], "b": [b""] * (len(own) - 1),
                "c": [(pair[x:y] % (MANY + 1)).astype("<u2").tobytes() for x, y in zip(own, own[1:])],
                "d": [n[x:y].astype("<u4").tobytes() for x, y in zip(own, own[1:])]}, schema=schema)

    def total(batches):
        """Add up the slices' counts of each chunk (rows of a chunk adjoin)."""
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_shingles", "k1", "k2", "possible")])
        held, rows = None, []

        def done():
            info = next(r for r in rows if r[0])
            ids, n, k1, k2 = np.frombuffer(info[0], "<i8").reshape(4, -1)
            possible = np.frombuffer(info[1], "<u4").astype(np.int64)
            for b, c, d in rows:
                if not b:
                    np.add.at(possible, np.frombuffer(c, "<u2"), np.frombuffer(d, "<u4").astype(np.int64))
            first = np.frombuffer(info[2], "<i4")
            possible = np.where(first >= 0, possible[first], 0)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, n, k1, k2, possible)], schema=schema)

        for batch in batches:
            for chunk, *blobs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "b", "c", "d"))):
                if held is not None and chunk != held:
                    yield done()
                    rows = []
                held = chunk
                rows.append(blobs)
        if rows:
            yield done()

    sent = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(released(send), ROOT)
    met = sent.repartitionById(parts, F.col("at")).mapInArrow(released(meet), "chunk long, b binary, c binary, d binary")
    return (met.repartition(parts, "chunk").sortWithinPartitions("chunk")
            .mapInArrow(released(total), "doc_id long, n_shingles long, k1 long, k2 long, possible long"))


# --- branches --------------------------------------------------------------

def survivor_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Chunks of documents with their sets: (chunk, docs, sizes, tokens)."""

    def run(batches):
        k = 0
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                values, n = chunk_sets(part)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk_id(k)], pa.int64()),
                    "docs": [part.column("doc_id").to_numpy().astype("<i8").tobytes()],
                    "sizes": [n.astype("<i8").tobytes()], "tokens": [values.astype("<u8").tobytes()]})
                k += 1

    # Spark broadcasts the ids if they are few and merges both sides if not
    kept = docs.select(F.col("doc_id").cast("long"), "text").join(ids.select("doc_id"), "doc_id", "left_semi")
    return materialize(kept.mapInArrow(released(run), "chunk long, docs binary, sizes binary, tokens binary"), "sets")


def rare_tokens(sets: DataFrame, threshold: Fraction, parts: int) -> DataFrame:
    """(token, doc_id, n): the tokens that other documents have too among the
    rarest ``n - ceil(threshold * n) + 1`` of each document, documents whose
    greatest possible overlap is too small left out.  How many documents have
    a token is counted exactly: chunks send each distinct token once with its
    count, and the totals come back."""

    def send(batches):
        for batch in batches:
            for chunk, tokens in zip(batch.column("chunk").to_pylist(), batch.column("tokens")):
                values = np.sort(np.frombuffer(tokens.as_buffer(), "<u8"))
                start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[:len(values)])
                values, n = values[start], np.diff(start, append=len(values))
                lane = slice_of(values, parts).astype(np.int64)
                cuts = np.flatnonzero(np.diff(lane, prepend=-1, append=parts))
                spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array([int(lane[a]) for a, _ in spans], pa.int32()),
                    "chunk": pa.array([chunk] * len(spans), pa.int64()),
                    "tokens": pa.array([values[a:b].tobytes() for a, b in spans], pa.binary()),
                    "n": pa.array([n[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary())})

    def add(batches):
        chunks, ats, tokens, counts = [], [], [], []
        for batch in batches:
            for at, chunk, t, n in zip(*(c.to_pylist() for c in batch.columns)):
                chunks.append(chunk)
                ats.append(at)
                tokens.append(np.frombuffer(t, "<u8"))
                counts.append(np.frombuffer(n, "<u4"))
        if not chunks:
            return
        lens = np.array([len(t) for t in tokens])
        token = np.concatenate(tokens)
        del tokens
        order = np.argsort(token)
        token = token[order]
        start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))[:len(token)])
        times = np.diff(start, append=len(token))
        del token
        total = np.concatenate(counts)
        del counts
        if len(start):
            total[order] = np.repeat(np.add.reduceat(total[order], start, dtype="<u4"), times)
        del order
        for chunk, at, n in zip(chunks, ats, to_list(total, lens)):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "at": pa.array([at], pa.int32()),
                                              "docs": [n], "sizes": [b""], "tokens": [b""]})

    def choose(batches):
        held, rows = None, []

        def done():
            own = next(r for r in rows if r[0] < 0)
            docs, sizes, tokens = (np.frombuffer(x, t) for x, t in zip(own[1:], ("<i8", "<i8", "<u8")))
            values = distinct(tokens)
            # the slices ascend, so their counts line up with the distinct tokens
            count = np.concatenate([np.frombuffer(r[1], "<u4") for r in sorted(r for r in rows if r[0] >= 0)]
                                   or [np.empty(0, "<u4")])
            df = count[np.searchsorted(values, tokens)].astype(np.int64)
            doc = np.repeat(np.arange(len(docs)), sizes)
            order = np.lexsort((tokens, df, doc))
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            need = -(-sizes * threshold.numerator // threshold.denominator)
            alive = np.bincount(doc[df > 1], minlength=len(docs)) >= need
            df, token = df[order], tokens[order]
            pick = (place < np.repeat(sizes - need + 1, sizes)) & (df > 1) & np.repeat(alive, sizes)
            return pa.RecordBatch.from_pydict({
                "token": token[pick].view("<i8"), "doc_id": docs[doc[pick]],
                "n": sizes[doc[pick]]}, schema=pa.schema([(c, pa.int64()) for c in ("token", "doc_id", "n")]))

        for batch in batches:
            for chunk, *row in zip(*(batch.column(c).to_pylist() for c in ("chunk", "at", "docs", "sizes", "tokens"))):
                if held is not None and chunk != held:
                    yield done()
                    rows = []
                held = chunk
                rows.append(tuple(row))
        if rows:
            yield done()

    sent = sets.select("chunk", "tokens").mapInArrow(released(send), "at int, chunk long, tokens binary, n binary")
    layout = "chunk long, at int, docs binary, sizes binary, tokens binary"
    back = sent.repartitionById(parts, F.col("at")).mapInArrow(released(add), layout)
    both = back.unionByName(sets.select("chunk", F.lit(-1).alias("at"), "docs", "sizes", "tokens"))
    return (both.repartition(parts, "chunk").sortWithinPartitions("chunk", "at")
            .mapInArrow(released(choose), "token long, doc_id long, n long"))


def plan_units(rare: DataFrame, block_docs: int, block_tokens: int, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(unit, side, doc_id): branches, and pairs of blocks of large branches."""
    low = rare.groupBy("token").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    edges = rare.join(low, "token").where("doc_id != low").select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct()
    branch = components(edges)
    docs = rare.groupBy("doc_id").agg(F.max("n").alias("n"))
    docs = materialize(docs.join(branch, F.col("node") == F.col("doc_id")).select("doc_id", "n", "component"), "branches")
    return block_units(docs, block_docs, block_tokens, threshold=threshold)


def block_units(docs: DataFrame, block_docs: int, block_tokens: int, member: str = "doc_id",
                threshold: Fraction = THRESHOLD) -> DataFrame:
    """(unit, side, member) of rows (member, n, component).

    A component of at most ``block_docs`` documents and ``block_tokens`` tokens
    is one unit.  A larger one is cut into blocks of one size class each (sizes
    in [r^c, r^(c+1)) with r the inverse of ``threshold``, 4/3 at least: linked
    sets lie in the same or adjoining classes), and every pair of blocks that can hold a link is a unit."""
    ratio = max(4 / 3, float(1 / threshold))
    size = docs.groupBy("component").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens"))
    big = size.where((F.col("docs") > block_docs) | (F.col("tokens") > block_tokens)).select("component")
    small = (docs.join(big, "component", "left_anti")
             .select(F.xxhash64("component").alias("unit"), F.lit(0).alias("side"), member))
    large = docs.join(big, "component").withColumn("class", F.floor(F.log("n") / math.log(ratio) + 1e-9).cast("int"))
    per_class = (large.groupBy("component", "class").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens"))
                 .select("component", "class", F.greatest(F.ceil(F.col("docs") / block_docs),
                                                          F.ceil(F.col("tokens") / block_tokens)).alias("blocks")))
    placed = (large.join(per_class, ["component", "class"])
              .withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")))
              .select("component", "class", "block", member))
    # a hash may leave blocks of few long documents empty: those make no unit
    blocks = placed.select("component", "class", "block").distinct()
    other = blocks.select("component", F.col("class").alias("class2"), F.col("block").alias("block2"))
    pairs = (blocks.join(other, "component")
             .where((F.col("class2") == F.col("class")) & (F.col("block") <= F.col("block2"))
                    | (F.col("class2") == F.col("class") + 1))
             .withColumn("unit", F.xxhash64("component", "class", "block", "class2", "block2")))
    same = (F.col("class") == F.col("class2")) & (F.col("block") == F.col("block2"))
    left = pairs.select("unit", F.lit(0).alias("side"), "component", "class", "block")
    right = pairs.where(~same).select("unit", F.lit(1).alias("side"), "component", F.col("class2").alias("class"),
                                      F.col("block2").alias("block"))
    paired = left.unionByName(right).join(placed, ["component", "class", "block"]).select("unit", "side", member)
    return small.unionByName(paired)


# --- trees -----------------------------------------------------------------

class SignatureTree:
    """Bitmaps and size ranges over documents; level 0 holds the documents.

    ``excess`` is the greatest number of tokens of a document below a node
    that share a bit with another one of the same document: the overlap with
    any set is at most the common bits plus the excess."""

    FAN = 8

    def __init__(self, sets: list[np.ndarray], bits: int):
        n = np.array([len(s) for s in sets], np.int64)
        words = bits // 64
        maps = np.zeros((len(sets), words), np.uint64)
        for k, s in enumerate(sets):
            at = (s >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
            np.bitwise_or.at(maps[k], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        excess = n - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        self.levels = [(maps, n, n, excess)]
        while len(maps) > 1:
            cut = np.arange(0, len(maps), self.FAN)
            maps = np.bitwise_or.reduceat(maps, cut, axis=0)
            _, low, high, excess = self.levels[-1]
            self.levels.append((maps, np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                                np.maximum.reduceat(excess, cut)))

    @property
    def height(self) -> int:
        return len(self.levels) - 1


def can_link(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, threshold: Fraction, step: int = 4096) -> np.ndarray:
    """Which pairs of nodes (rows ``i`` of level x, ``j`` of level y) may hold a link."""
    p, q = threshold.numerator, threshold.denominator
    ok = (x[2][i] * q >= y[1][j] * p) & (y[2][j] * q >= x[1][i] * p)
    at = np.flatnonzero(ok)
    for k in range(0, len(at), step):
        a, b = i[at[k:k + step]], j[at[k:k + step]]
        common = np.bitwise_count(x[0][a] & y[0][b]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(x[3][a], y[3][b])
        # overlap / (a + b - overlap) >= p / q needs overlap * (p + q) >= p * (a + b)
        ok[at[k:k + step]] = most * (p + q) >= p * (x[1][a] + y[1][b])
    return ok


def dual_traversal(x: SignatureTree, y: SignatureTree, threshold: Fraction, own: bool, limit: int = 1 << 20):
    """Yields arrays of document pairs that the bounds leave; with ``own`` both
    trees are the same and pairs come once.  The frontier is cut into pieces of
    about ``limit`` pairs, taken deepest first, so it stays small."""
    stack = [(x.height, y.height, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        lx, ly, i, j = stack.pop()
        keep = can_link(x.levels[lx], y.levels[ly], i, j, threshold)
        i, j = i[keep], j[keep]
        if lx == 0 and ly == 0:
            if own:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        if not len(i):
            continue

        def children(node, level, tree):
            if level == 0:
                return node, np.ones(len(node), np.int64)
            below = len(tree.levels[level - 1][1])
            first = node * tree.FAN
            return first, np.minimum(first + tree.FAN, below) - first

        # the higher tree goes down first; equal heights go down together
        fx, nx = children(i, lx if lx >= ly else 0, x)
        fy, ny = children(j, ly if ly >= lx else 0, y)
        many = nx * ny
        piece = np.cumsum(many) // limit
        for k in np.unique(piece):
            at = np.flatnonzero(piece == k)
            pair = np.repeat(at, many[at])
            inner = ragged(np.zeros(len(at), np.int64), many[at])
            ci, cj = fx[pair] + inner // ny[pair], fy[pair] + inner % ny[pair]
            if own and lx == ly:
                up = ci <= cj
                ci, cj = ci[up], cj[up]
            stack.append((lx - (lx >= ly and lx > 0), ly - (ly >= lx and ly > 0), ci, cj))


def linked_pairs(left: list, right: list | None, threshold: Fraction, max_bits: int = 1 << 16) -> list[tuple[int, int]]:
    """Spanning links among (doc_id, set) entries: of one block, or between two.

    Pairs whose documents earlier links connect already are not verified."""
    p, q = threshold.numerator, threshold.denominator
    order = lambda e: (len(e[1]), int(e[1][0]))  # noqa: E731  near copies side by side
    left = sorted(left, key=order)
    right = None if right is None else sorted(right, key=order)
    docs = left + (right or [])
    sets = [s for _, s in docs]
    longest = max(len(s) for s in sets)
    bits = min(max_bits, max(64, 1 << (8 * longest - 1).bit_length()))
    x = SignatureTree([s for _, s in left], bits)
    y = x if right is None else SignatureTree([s for _, s in right], bits)
    shift = 0 if right is None else len(left)
    label = np.arange(len(docs))
    out = []
    for i, j in dual_traversal(x, y, threshold, right is None):
        j = j + shift
        k, step = 0, 64
        while k < len(i):
            for a, b in zip(i[k:k + step].tolist(), j[k:k + step].tolist()):
                if label[a] == label[b]:
                    continue
                u, v = sets[a], sets[b]
                if len(u) > len(v):
                    u, v = v, u
                both = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                if both * (p + q) >= p * (len(u) + len(v)):
                    out.append((docs[a][0], docs[b][0]))
                    label[label == label[b]] = label[a]
            k += step
            step *= 2
            rest = np.flatnonzero(label[i[k:]] != label[j[k:]])  # not connected so far
            i, j, k = i[k:][rest], j[k:][rest], 0
    return out


def verified_links(units: DataFrame, sets: DataFrame, threshold: Fraction, parts: int) -> DataFrame:
    """(a, b): links that connect, in each unit, all documents that any chain
    of links of the unit connects."""

    def rows(batches):
        for batch in batches:
            for docs, sizes, tokens in zip(*(batch.column(c).to_pylist() for c in ("docs", "sizes", "tokens"))):
                docs, sizes = np.frombuffer(docs, "<i8"), np.frombuffer(sizes, "<i8")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(docs, pa.int64()),
                    "set": pa.array(to_list(np.frombuffer(tokens, "<u8"), sizes), pa.binary())})

    def search(batches):
        held, sides = None, ([], [])

        def done():
            left, right = sides
            if left and (right or len(left) > 1):
                found = linked_pairs(left, right or None, threshold)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        for batch in batches:
            for unit, side, doc, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and unit != held:
                    yield from done()
                    sides = ([], [])
                held = unit
                sides[side].append((doc, np.frombuffer(data, "<u8")))
        yield from done()

    members = units.join(sets.mapInArrow(released(rows), "doc_id long, set binary"), "doc_id").select("unit", "side", "doc_id", "set")
    return (members.repartition(parts, "unit").sortWithinPartitions("unit", "side", "doc_id")
            .mapInArrow(released(search), "a long, b long"))


def join_components(docs: DataFrame, threshold: Fraction = THRESHOLD, block_docs: int = 1024,
                    block_tokens: int = 4 << 20) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text")
    all_docs = materialize(root_candidates(rows, threshold), "root")
    key = ["k1", "k2", "n_shingles"]
    # equal sets: all but the smallest id follow it
    first = (all_docs.where("n_shingles > 0").groupBy(*key)
             .agg(F.min("doc_id").alias("rep"), F.max("possible").alias("possible")))
    need = F.ceil(F.col("n_shingles") * threshold.numerator / threshold.denominator)
    ids = materialize(first.where(F.col("possible") >= need).select(F.col("rep").alias("doc_id")), "candidates")
    sets = survivor_sets(rows, ids)
    rare = materialize(rare_tokens(sets, threshold, parts), "rare-tokens")
    units = materialize(plan_units(rare, block_docs, block_tokens, threshold), "units")
    links = verified_links(units, sets, threshold, parts)
    same = all_docs.where("n_shingles > 0").join(first, key).where("doc_id != rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(same))
    return (all_docs.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
            .join(found, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def op10(docs: DataFrame) -> DataFrame:
    return join_components(docs)
