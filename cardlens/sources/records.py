"""CSV records that may hold line breaks, from files that stay splittable.

Spark's ``multiLine`` option reads a file in one task.  Here a file is read as
lines, in splits, and the borders of records follow from quotes: a line break
is part of a field if an odd number of quotes stands before it in the file.

1. ``line_quotes`` counts the quotes of each line that open or close a field;
   the counts are added up by split, and a prefix sum over the splits of a file
   (one row per split) tells which splits begin inside a field.
2. If no line has an odd count, every line is a record, and the ordinary
   reader does the rest (``has_broken_records``).
3. Otherwise each task joins the lines of its splits to records
   (``csv_records``).  What is cut by a border of splits, two pieces per split
   at most, is put together by one more grouping.

Quotes are escaped by doubling; a quote in the middle of an unquoted field is
an ordinary character, as it is for the parser.  A file whose quotes do not
come out even has a field that never ends: its lines are taken as records, so
that the parser drops and counts the broken ones and keeps the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A quote next to a comma or to an end of the line.
_BORDER = r'(?<![^,])"|"(?![^,])'
_WHOLE, _TAIL, _MIDDLE, _HEAD = 0, 1, 2, 3


def line_quotes(value: Column) -> Column:
    """0 or 1: does the line change whether a field is open?"""
    count = F.regexp_count(F.regexp_replace(value, '""', ""), F.lit(_BORDER))
    return F.when(value.contains('"'), count % 2).otherwise(F.lit(0)).cast("int")


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value, odd): the lines, in order within each split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        "value", line_quotes(F.col("value")).alias("odd"))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, odd_lines, open, plain): one row per split; ``open`` tells
    whether it begins inside a field, ``plain`` that the file's quotes do not
    come out even.  Stored, as it is read more than once."""
    splits = lines.groupBy("file", "start").agg(F.sum("odd").alias("odd_lines"))
    whole = Window.partitionBy("file")
    before = F.sum("odd_lines").over(whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    path = scratch_path(lines.sparkSession, "csv-splits")
    (splits.withColumn("open", F.coalesce(before, F.lit(0)) % 2 == 1)
     .withColumn("plain", F.sum("odd_lines").over(whole) % 2 == 1).write.parquet(path))
    return lines.sparkSession.read.parquet(path)


def has_broken_records(splits: DataFrame) -> bool:
    return splits.where("odd_lines > 0 AND NOT plain").limit(1).count() > 0


def _join_lines(open_at: set, plain: set):
    """Lines -> (file, start, seq, kind, record), split by split; ``open_at``
    are the splits that begin inside a field, ``plain`` files whose lines are
    records."""

    def run(batches):
        key, seq, held, held_kind, state, by_line = None, 0, [], None, 0, False
        rows = []

        def put(kind, record):
            nonlocal seq
            rows.append((key[0], key[1], seq, kind, record))
            seq += 1

        def close_split():
            if held:
                put(_MIDDLE if held_kind == _TAIL else _HEAD, "\n".join(held))

        for batch in batches:
            rows = []
            for file, start, value, odd in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value", "odd"))):
                if (file, start) != key:
                    if key is not None:
                        close_split()
                    key, seq, held = (file, start), 0, []
                    by_line = file in plain
                    state = int(not by_line and (file, start) in open_at)
                    held_kind = _TAIL if state else _WHOLE
                held.append(value)
                state ^= odd and not by_line
                if not state:
                    put(held_kind, "\n".join(held))
                    held, held_kind = [], _WHOLE
            yield _batch(rows)
        if key is not None:
            rows = []
            close_split()
            yield _batch(rows)

    return run


def _batch(rows: list) -> pa.RecordBatch:
    file, start, seq, kind, record = map(list, zip(*rows)) if rows else ([], [], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(file, pa.string()), pa.array(start, pa.int64()), pa.array(seq, pa.int64()),
         pa.array(np.array(kind, np.int32)), pa.array(record, pa.string())],
        ["file", "start", "seq", "kind", "record"])


def csv_records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, start, seq, record): each record of the source once, stored.

    The splits that begin inside a field and the plain files are sent to the
    tasks: at most one entry per split of the source."""
    spark = lines.sparkSession
    known = spark.sparkContext.broadcast((
        {(r.file, r.start) for r in splits.where("open AND NOT plain").collect()},
        {r.file for r in splits.where("plain").select("file").distinct().collect()}))

    def run(batches):
        yield from _join_lines(*known.value)(batches)

    path = scratch_path(spark, "csv-records")
    (lines.mapInArrow(run, "file string, start long, seq long, kind int, record string")
     .write.partitionBy("kind").parquet(path))
    stored = spark.read.parquet(path)
    pieces = stored.where(F.col("kind") != _WHOLE)
    # a record begins at a head; the middles and the tail of the splits after it belong to it
    order = Window.partitionBy("file").orderBy("start", "seq")
    pieces = pieces.withColumn("number", F.sum((F.col("kind") == _HEAD).cast("int")).over(order))
    joined = (pieces.groupBy("file", "number")
              .agg(F.min(F.struct("start", "seq")).alias("at"),
                   F.array_sort(F.collect_list(F.struct("start", "seq", "record"))).alias("parts"))
              .select("file", "at.start", "at.seq", F.array_join("parts.record", "\n").alias("record")))
    return stored.where(F.col("kind") == _WHOLE).select("file", "start", "seq", "record").unionByName(joined)
