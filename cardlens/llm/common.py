"""Helpers shared by the operators: scratch tables, Arrow batches, words."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import path_size, scratch_path

#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession, batch_bytes: int = 8 << 20) -> None:
    """Give the executors this package (``addPyFile`` of a zip, once per
    application), so that Python workers import it wherever they start, and
    bound the batches that travel between the JVM and Python by their bytes
    (documents may be long; this changes no result)."""
    sc = spark.sparkContext
    if sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES)) > batch_bytes:
        spark.conf.set(BATCH_BYTES, str(batch_bytes))
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage: after an executor is lost, later stages read the written
    files and do not repeat the work above them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` that nothing reads any more."""
    for f in {os.path.dirname(p) for p in df.inputFiles()}:
        delete_path(df.sparkSession, f)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of scratch data (Hadoop file system)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tasks_for(spark: SparkSession, bytes_: int, target: int = 64 << 20) -> int:
    """Shuffle partitions for ``bytes_``: the session's number, or more when
    the partitions would pass ``target`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(bytes_ / target))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files below ``df`` (0 when it reads none)."""
    return sum(path_size(df.sparkSession, f) for f in df.inputFiles())


def binary_list(column: pa.Array | pa.ChunkedArray) -> list:
    """A string or binary column as Python bytes (None for nulls)."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows whose ``column`` holds about ``limit``
    bytes (one row at least), so that memory does not follow the batch size."""
    n = batch.num_rows
    if n == 0:
        return
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cut = np.cumsum(size.astype(np.int64)) // limit
    starts = np.flatnonzero(np.diff(cut, prepend=cut[0] - 1))
    for a, b in zip(starts, [*starts[1:], n]):
        yield batch.slice(a, b - a)


#: Called when a task of an ``arrow_*`` operator ends, in its Python worker.
AT_END: list[Callable[[], None]] = []


def release() -> None:
    """Give memory back at the end of a task: Spark keeps idle Python workers,
    which would otherwise hold what their largest task has used."""
    for free in AT_END:
        free()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` from batches to batches for ``mapInArrow``, then ``release``."""

    def whole(batches):
        yield from run(batches)
        release()

    return whole


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str,
              column: str | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` with ``fn`` from batch to batch (or dict of arrays);
    with ``column`` batches are cut by that column's bytes (``limit``) first."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for part in (slices(batch, column, limit) if column else [batch]):
                got = fn(part)
                if isinstance(got, dict):
                    got = pa.RecordBatch.from_arrays(
                        [pa.array(got[f.name], type=f.type) for f in out], schema=out)
                yield got
        release()

    return df.mapInArrow(run, schema)


def arrow_extend(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], extra: str, column: str,
                 limit: int = SLICE_BYTES) -> DataFrame:
    """All columns of ``df`` and those that ``fn`` makes of each batch; names
    of ``extra`` replace columns that have them already."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string
    added = _parse_datatype_string(extra)
    names = {f.name.lower() for f in added}
    kept = df.select(*[f"`{f.name}`" for f in df.schema if f.name.lower() not in names])
    schema = StructType(list(kept.schema) + list(added))
    types = to_arrow_schema(added)

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                got = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(got[f.name], type=f.type) for f in types)],
                    [*part.schema.names, *types.names])
        release()

    return kept.mapInArrow(run, schema)


def arrow_filter(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray], column: str,
                 limit: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``df`` that ``keep`` marks, all columns as they are."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                yield part.filter(pa.array(keep(part), pa.bool_()))
        release()

    return df.mapInArrow(run, df.schema)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices ``starts[0]..+lens[0], starts[1]..+lens[1], ...`` in one array."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values; unlike ``np.unique``, which hashes whole
    numbers, this takes no memory but that of a sorted copy."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix generator: a bijection on 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def split_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of all texts: (words per text, word numbers in order, distinct words).

    Words are runs of bytes other than 0x20 and 0x09-0x0D; with ``lower`` A-Z
    are lower-cased first.  A null text has no words.  Splitting and numbering
    run in Arrow; Python sees each distinct word of the slice once."""
    import pyarrow.compute as pc
    column = column.cast(pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column) if lower else column)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    if not len(words):
        return counts, np.empty(0, np.int32), []
    offs = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    data = words.buffers()[2]
    data = data.to_pybytes() if data is not None else b""
    distinct = [data[i:j] for i, j in zip(offs, offs[1:])]
    if b"" in distinct:  # at the ends of a text
        real = number != distinct.index(b"")
        ends = np.concatenate(([0], np.cumsum(real)))[np.concatenate(([0], np.cumsum(counts)))]
        counts, number = np.diff(ends), number[real]
    return counts, number, distinct


def word_hashes(words: list[bytes], seed: int = 7) -> np.ndarray:
    import xxhash
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def shingle_hashes(column: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all ``n``-word shingles, repeats kept, and their number
    by text.  A-Z are lower-cased; words as in ``split_words``.  With fewer
    than ``n`` words the whole sequence is one shingle; without words there
    is none."""
    counts, number, distinct = split_words(column, lower=True)
    h = word_hashes(distinct)[number] if len(number) else np.empty(0, np.uint64)
    size = np.minimum(counts, n)  # words per shingle of each text
    total = np.where(counts > 0, counts - size + 1, 0)
    at = ragged(np.cumsum(counts) - counts, total)
    size = np.repeat(size, total)
    acc, mult = size.astype(np.uint64), np.uint64(0x9E3779B97F4A7C15)
    all_long = bool(len(size)) and int(size.min()) == n
    for j in range(n):
        if all_long:
            acc = acc * mult + h[at + j]
        else:
            more = size > j
            acc[more] = acc[more] * mult + h[at[more] + j]
    return mix64(acc), total


def shingle_sets(column: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted 64-bit hashes: (hashes of all
    texts, number by text)."""
    v, total = shingle_hashes(column, n)
    ends = np.cumsum(total)
    for a, b in zip((ends - total).tolist(), ends.tolist()):
        v[a:b].sort()
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    new[(ends - total)[total > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return v[new], np.diff(kept[np.concatenate(([0], ends))])


class IntTable:
    """int64 keys (not negative) -> int32 values, looked up in bulk.

    Open addressing with linear probing; of equal keys the first one counts."""

    MISSING = np.int32(2**31 - 1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, self.MISSING, np.int32)
        for key, value, slot in zip(keys.tolist(), values.tolist(), self.slot(keys).tolist()):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & self.mask
            if self.keys[slot] == -1:
                self.keys[slot], self.values[slot] = key, value

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key; MISSING where there is none."""
        slot = self.slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], self.MISSING)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out


__all__ = ["AT_END", "BATCH_BYTES", "release", "released", "IntTable", "ship_package", "read_table", "materialize", "discard", "delete_path", "tasks_for", "input_bytes", "binary_list", "slices",
           "arrow_map", "arrow_extend", "arrow_filter", "ragged", "distinct", "mix64", "split_words", "word_hashes",
           "shingle_hashes", "shingle_sets"]
