"""Merkle manifest of a dataset with versions by path copying (operator 12).

Every row is a leaf, every ``lang`` a tree over its leaves in ascending
doc_id order, and the trees' roots, in the order of their languages, are the
leaves of one last tree.  Two neighbours become the hash of their two digests
(as hex text), a node without a neighbour the hash of its own, until one is
left.

A tree is cut into aligned blocks of ``BLOCK`` leaves.  Blocks are built in
tasks of their own, their roots are the leaves of the next level's blocks, and
so on until every tree is one block (``climb``).  On the way back each block
hands its children the siblings above them (``descend``), one row per child,
so that a leaf's whole proof is its block's siblings and one string.

A changed leaf is a version of its own: ``Block.version`` copies the ancestors
of that leaf and shares every other node with the untouched tree; the copies
go on above the block along the siblings handed down.  ``version_nodes``
returns the copied nodes, ``proofs`` the verdict on every leaf.

Nulls in a hashed column are hashed as ``-``.  Rows without language form a
tree of their own, the first one; rows without doc_id come first in their
tree and are never changed.  Rows of one doc_id are ordered by their leaf's
digest; equal rows are neighbours, each a leaf.  A null count of characters
stays null, so that changing such a row changes nothing.  Empty and very long
texts are hashed as they are (in the JVM).  An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import input_bytes, materialize, release, tasks_for

#: Leaves of a block, a power of two.
BLOCK = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(**changed: Column) -> Column:
    """Hex SHA-256 of the row's fields, ``changed`` ones in place of their columns."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed, salt): ``changed`` is the digest of the
    tampered row where 7 divides the checksum of the doc_id, else null; the
    salt tells equal rows apart so that they can be spread over tasks."""
    n_chars, doc_id = F.col("n_chars").cast("long"), F.col("doc_id").cast("long")
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    more = (n_chars.cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        doc_id.alias("doc_id"), leaf_digest().alias("leaf"),
        F.when(hit, leaf_digest(n_chars=more)).alias("changed"),
        F.monotonically_increasing_id().alias("salt"))


def ranked(rows: DataFrame, order: list[str], partitions: int) -> DataFrame:
    """``rows`` with ``rank`` (position within ``tree`` by ``order``, nulls
    first) and ``total`` (rows of the tree).

    The rows are stored in ranges of (tree, order); a task numbers its own
    run of each tree, and the counts of runs, one row per range and tree,
    give every run its offset."""
    schema = rows.withColumns({"part": F.lit(0), "pos": F.lit(0).cast("long")}).schema

    def number(batches):
        from pyspark import TaskContext
        part, tree, pos = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for t in batch.column("tree").to_pylist():
                pos = pos + 1 if t == tree else 0
                tree = t
                places.append(pos)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
                [*batch.schema.names, "part", "pos"])

    stored = materialize(rows.repartitionByRange(partitions, "tree", *order)
                         .sortWithinPartitions("tree", *order).mapInArrow(number, schema), "merkle-order")
    whole = Window.partitionBy("tree")
    runs = (stored.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
            .select("tree", "part",
                    F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(0)).alias("before"),
                    F.sum("n").over(whole).alias("total")))
    return (stored.join(runs, ["tree", "part"])
            .withColumn("rank", F.col("before") + F.col("pos")).drop("part", "pos", "before"))


class Block:
    """The nodes of one aligned block, level by level from its leaves.

    ``deep`` blocks belong to a larger tree and rise by all their levels, even
    over a single node; the others stop at one node."""

    def __init__(self, nodes: list[str], deep: bool, size: int):
        self.levels = [nodes]
        while len(nodes) > 1 or (deep and len(self.levels) < size.bit_length()):
            nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
            self.levels.append(nodes)
        self.root = nodes[0]

    def path(self, i: int) -> str:
        """Siblings of leaf ``i`` upwards: ``L`` or ``R`` (their side) and the
        digest, or ``-`` for none."""
        out = []
        for nodes in self.levels[:-1]:
            j = i ^ 1
            out.append("-" if j >= len(nodes) else ("R" if j > i else "L") + nodes[j])
            i >>= 1
        return "".join(out)

    def version(self, i: int, leaf: str) -> list[str]:
        """The nodes that a new leaf ``i`` copies, from the leaf to the block's
        root; all others are shared with this block."""
        copied = [leaf]
        for nodes in self.levels[:-1]:
            j = i ^ 1
            pair = [copied[-1]] if j >= len(nodes) else [copied[-1], nodes[j]] if j > i else [nodes[j], copied[-1]]
            copied.append(digest(*pair))
            i >>= 1
        return copied


def siblings(path: str) -> Iterator[tuple[str, str]]:
    """(side, digest) of each step of a path, ("-", "") where there is none."""
    at = 0
    while at < len(path):
        size = 1 if path[at] == "-" else 65
        yield path[at], path[at + 1:at + size]
        at += size


def ascend(node: str, path: str) -> list[str]:
    """The ancestors of ``node`` along ``path``, without ``node``."""
    out = []
    for side, other in siblings(path):
        node = digest(node) if side == "-" else digest(node, other) if side == "R" else digest(other, node)
        out.append(node)
    return out


def _groups(batches, names: list[str]):
    """Runs of rows with equal (tree, block), as lists of the named columns."""
    key, held = None, None
    for batch in batches:
        trees, blocks = batch.column("tree").to_pylist(), batch.column("block").to_pylist()
        columns = [batch.column(n).to_pylist() for n in names]
        for k, *values in zip(zip(trees, blocks), *columns):
            if k != key:
                if held:
                    yield key, held
                key, held = k, [[] for _ in names]
            for out, v in zip(held, values):
                out.append(v)
    if held:
        yield key, held


def grouped(nodes: DataFrame, size: int, partitions: int, extra: list[str] = ()) -> DataFrame:
    """Nodes (tree, rank, total, node) as one row per aligned block: (tree,
    block, total, nodes, root) and the ``extra`` columns as arrays."""
    types = dict(nodes.dtypes)
    schema = ("tree string, block long, total long, nodes array<string>, root string"
              + "".join(f", {n} array<{types[n]}>" for n in extra))
    out = to_arrow_schema(_parse_datatype_string(schema))

    def build(batches):
        for (tree, block), (total, node, *rest) in _groups(batches, ["total", "node", *extra]):
            root = Block(node, total[0] > size, size).root
            yield pa.RecordBatch.from_pydict(
                dict(zip(out.names, ([tree], [block], total[:1], [node], [root], *([r] for r in rest)))), schema=out)
        release()

    rows = nodes.withColumn("block", F.expr(f"rank div {size}"))
    return materialize(rows.repartition(partitions, "tree", "block").sortWithinPartitions("tree", "block", "rank")
                       .mapInArrow(build, schema), "merkle-blocks")


def climb(nodes: DataFrame, size: int, partitions: int, extra: list[str] = ()) -> list[DataFrame]:
    """Levels of blocks, the last one with a single block per tree."""
    levels = [grouped(nodes, size, partitions, extra)]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > size:
        up = levels[-1].select("tree", F.col("block").alias("rank"),
                               F.ceil(F.col("total") / size).cast("long").alias("total"), F.col("root").alias("node"))
        levels.append(grouped(up, size, partitions))
    return levels


def descend(levels: list[DataFrame], top: DataFrame, size: int) -> DataFrame:
    """The lowest level's blocks with ``path`` (siblings above the block) and
    the columns of ``top`` (tree, path, ...), which has one row per tree."""
    names = [c for c in top.columns if c not in ("tree", "path")]
    here = levels[-1].join(top, "tree")
    for level in reversed(levels[:-1]):
        schema = "tree string, block long, path string" + "".join(f", {n} string" for n in names)
        here = level.join(here.mapInArrow(_children(size, names), schema), ["tree", "block"])
    return here


def _children(size: int, names: list[str]):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r["nodes"], r["total"] > size, size)
                first = r["block"] * size
                n = len(r["nodes"])
                yield pa.RecordBatch.from_pydict({
                    "tree": [r["tree"]] * n, "block": pa.array(range(first, first + n), pa.int64()),
                    "path": [block.path(i) + r["path"] for i in range(n)], **{c: [r[c]] * n for c in names}})
        release()
    return run


@dataclass
class Manifest:
    """``blocks``: one row per block of leaves: tree, block, total, doc_id,
    nodes (leaves), changed, root (of the block), path, subroot, top."""

    blocks: DataFrame
    size: int


def build(docs: DataFrame, size: int = BLOCK) -> Manifest:
    """Hash ``docs`` and build all trees; every step is stored."""
    if size < 2 or size & (size - 1):
        raise ValueError("the block size must be a power of two")
    spark = docs.sparkSession
    rows = materialize(leaves(docs), "merkle-leaves")
    partitions = tasks_for(spark, input_bytes(rows))
    order = ranked(rows, ["doc_id", "leaf", "salt"], partitions)
    levels = climb(order.withColumnRenamed("leaf", "node"), size, partitions, ["doc_id", "changed"])

    roots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
    order = ranked(roots, ["name"], partitions)
    above = climb(order, size, partitions, ["name"])
    last = above[-1].select("tree", F.lit("").alias("path"), F.col("root").alias("top"))
    top = descend(above, last, size).mapInArrow(
        _named(size), "tree string, path string, subroot string, top string")
    return Manifest(materialize(descend(levels, materialize(top, "merkle-top"), size), "merkle-manifest"), size)


def _named(size: int):
    """Blocks of subroots -> one row per subroot, ``tree`` being its name."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r["nodes"], r["total"] > size, size)
                yield pa.RecordBatch.from_pydict({
                    "tree": r["name"], "path": [block.path(i) + r["path"] for i in range(len(r["nodes"]))],
                    "subroot": r["nodes"], "top": [r["top"]] * len(r["nodes"])})
    return run


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf's digest, roots and proof, and what its tampered version (its
    own leaf where nothing was changed) folds to."""
    size = manifest.size
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r["nodes"], r["total"] > size, size)
                above = "".join(d for _, d in siblings(r["path"]))
                rows = []
                for i, (doc_id, leaf, changed) in enumerate(zip(r["doc_id"], r["nodes"], r["changed"])):
                    copied = block.version(i, changed or leaf)
                    folded = (copied + ascend(copied[-1], r["path"]))[-1]
                    proof = digest("".join(d for _, d in siblings(block.path(i))), above)
                    rows.append((doc_id, leaf, r["subroot"], r["top"], proof, folded, folded == r["top"]))
                columns = dict(zip(names, map(list, zip(*rows))))
                columns["doc_id"] = pa.array(columns["doc_id"], pa.int64())
                yield pa.RecordBatch.from_pydict(columns)
        release()

    return manifest.blocks.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, "
                                           "proof_sha256 string, folded_root string, verified boolean")


def version_nodes(manifest: Manifest) -> DataFrame:
    """The nodes that each changed leaf's version copies: (tree, rank, doc_id,
    level, digest).  ``rank`` names the version, level 0 is the leaf and the
    last level the version's root; everything else is shared."""
    size = manifest.size

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                block, rows = Block(r["nodes"], r["total"] > size, size), []
                for i, (doc_id, leaf) in enumerate(zip(r["doc_id"], r["changed"])):
                    if leaf is not None:
                        copied = block.version(i, leaf)
                        copied += ascend(copied[-1], r["path"])
                        rows += [(r["tree"], r["block"] * size + i, doc_id, k, d) for k, d in enumerate(copied)]
                if rows:
                    tree, rank, ids, level, digests = map(list, zip(*rows))
                    yield pa.RecordBatch.from_pydict({
                        "tree": tree, "rank": pa.array(rank, pa.int64()), "doc_id": pa.array(ids, pa.int64()),
                        "level": pa.array(level, pa.int32()), "digest": digests})
        release()

    return manifest.blocks.mapInArrow(run, "tree string, rank long, doc_id long, level int, digest string")


def op12(docs: DataFrame) -> DataFrame:
    return proofs(build(docs))
