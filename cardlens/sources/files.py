"""File sources: CSV ingest with malformed-row handling.

The header line decides which columns a file has and where they stand: a
known name takes its type from the schema, any other column takes the narrowest
type that holds all its values (``column_types``), and a file that lacks a
required column, names a column twice or whose part files have different
headers is an error.  Rows are parsed in PERMISSIVE mode; a row that does not
fit lands in the corrupt-record column and is dropped, and an ingest that drops
too large a share of the rows fails.  Quoted fields may hold line breaks
(``records``); quotes inside them are doubled.

The ingest writes Parquet right away: the CSV parser prunes columns, so which
rows count as malformed would otherwise depend on the columns a later query
reads.  Writing every column parses every column, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_COLUMN, KEY, M_BOOL_COLS, with_corrupt_column
from ..session import scratch_path
from .column_types import narrowest, types_of_column
from .records import csv_lines, csv_records, has_broken_records, split_states


class SourceError(ValueError):
    """A file source that cannot be loaded as it is."""


def header_schema(spark: SparkSession, path: str, schema: T.StructType,
                  required: Sequence[str] | None = None) -> T.StructType:
    """The schema of a CSV source in file order, from its header line.

    ``required`` (default: all names of ``schema``) must be present."""
    first = spark.read.option("header", False).option("inferSchema", False).csv(path).first()
    names = [(c or "").strip() for c in (first or [])]
    twice = sorted({c for c in names if names.count(c) > 1})
    absent = [c for c in (schema.names if required is None else required) if c not in names]
    if twice or absent or "" in names:
        raise SourceError(f"{path}: header lacks {absent}, repeats {twice}" + ", has an empty name" * ("" in names))
    known = {f.name: f for f in schema.fields}
    return T.StructType([known.get(c, T.StructField(c, T.StringType(), True)) for c in names])


#: How a row is parsed: quotes inside a field are doubled.
_PARSING = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             required: Sequence[str] | None = None, line_breaks: bool | None = None) -> DataFrame:
    """CSV with a header, bound by name, plus the corrupt-record column.

    ``line_breaks``: may a quoted field hold one?  ``None`` looks for it, one
    pass over the lines that counts quotes; ``False`` (known to be absent)
    saves that pass.  Without any, Spark's reader takes the lines as they are
    (``enforceSchema`` off makes it compare the header of every part file with
    the schema); otherwise records are put together first."""
    fields = with_corrupt_column(header_schema(spark, path, schema, required))
    if line_breaks is not False:
        lines = csv_lines(spark, path)
        splits = split_states(lines)
        if has_broken_records(splits):
            return parse_records(csv_records(lines, splits), fields, path)
    return (spark.read.schema(fields).options(**_PARSING)
            .option("header", True).option("enforceSchema", False).option("columnPruning", False).csv(path))


def parse_records(records: DataFrame, fields: T.StructType, path: str) -> DataFrame:
    """Records (file, start, seq, record) parsed; the first one of each file
    is its header and must name the columns in their order."""
    first = (F.col("start") == 0) & (F.col("seq") == 0)
    names = [f.name for f in fields if f.name != CORRUPT_COLUMN]
    header = ", ".join(f"`{i}` string" for i in range(len(names)))
    heads = records.where(first).select(F.from_csv("record", header, {"escape": '"'}).alias("h"))
    other = heads.where(~F.array(*[F.trim(F.col("h")[str(i)]) for i in range(len(names))])
                        .eqNullSafe(F.array(*map(F.lit, names))))
    if other.limit(1).count():
        raise SourceError(f"{path}: the header of a part file differs")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    return (records.where(~first & (F.length("record") > 0))
            .select(F.from_csv("record", ddl, _PARSING).alias("r")).select("r.*"))


def to_boolean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text flags to BOOLEAN with ``try_cast``: 'T'/'F', 'true'/'false' and
    the like convert, other text becomes NULL (a plain cast would raise)."""
    present = set(columns) & set(df.columns)
    return df.select(*[F.col(c).try_cast("boolean").alias(c) if c in present else F.col(c)
                       for c in df.columns])


def drop_malformed(raw: DataFrame) -> DataFrame:
    return raw.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def ingest_csv(spark: SparkSession, src: str, dest: str, schema: T.StructType,
               bool_columns: list[str] = M_BOOL_COLS, limit: int | None = None,
               order_by: str = KEY, table: str | None = None,
               buckets: int | None = None, required: Sequence[str] | None = None,
               max_malformed_share: float = 0.5, line_breaks: bool | None = None) -> tuple[DataFrame, dict]:
    """CSV -> Parquet at ``dest``; returns (table over ``dest``, counts).

    ``counts`` holds the source's ``file`` name, ``rows`` written and
    ``malformed`` rows dropped, gathered by an ``Observation`` on the write
    itself (no second pass); a greater share of malformed rows than
    ``max_malformed_share`` is an error.  ``limit`` keeps the first ``limit``
    rows by ``order_by`` (S2); ``line_breaks`` as in ``read_csv``.

    With ``table`` and ``buckets`` the rows are stored as a catalog table at
    ``dest`` bucketed (and sorted) by ``order_by``: one file per bucket, since
    the rows are dealt out by the key first.  Two sources bucketed the same
    way on the join key are joined later without any shuffle: at scale that
    removes the exchange of the wide transaction rows from the merge.
    """
    raw = read_csv(spark, src, schema, required, line_breaks)
    obs_in = Observation("csv_in")
    raw = raw.observe(obs_in, F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("malformed"),
                      F.count(F.lit(1)).alias("all"))
    good = to_boolean(drop_malformed(raw), bool_columns)
    unknown = [c for c in good.columns if c not in schema.names]
    if unknown:
        good = typed(good, unknown)
    if limit is not None:
        good = sample_limit(good, limit, order_by)
    obs_out = Observation("csv_out")
    good = good.observe(obs_out, F.count(F.lit(1)).alias("rows"))
    if table and buckets:
        (good.repartition(buckets, order_by).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, order_by).sortBy(order_by).option("path", dest).saveAsTable(table))
        out = spark.table(table)
    else:
        good.write.mode("overwrite").parquet(dest)
        out = spark.read.parquet(dest)
    seen = obs_in.get
    counts = {"file": file_name(src), "rows": int(obs_out.get["rows"]), "malformed": int(seen["malformed"])}
    if counts["malformed"] > max_malformed_share * max(int(seen["all"]), 1):
        raise SourceError(f"{src}: {counts['malformed']} of {seen['all']} rows are malformed")
    return out, counts


def typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the text ``columns`` in the narrowest type that holds all
    their values.  The rows are stored once as text, the types ride on that
    write (``Observation``), and the stored rows are cast as they are read."""
    spark = df.sparkSession
    path, obs = scratch_path(spark, "untyped"), Observation("types")
    df.observe(obs, *[types_of_column(c).alias(f"t{i}") for i, c in enumerate(columns)]).write.parquet(path)
    kinds = {c: narrowest(obs.get[f"t{i}"]) for i, c in enumerate(columns)}
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string"
                           else F.col(f"`{c}`") for c in stored.columns])


def file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


#: Keys that the driver's one ordered query may see at the end of a search.
EXACT_ROWS = 100_000
#: Ranges that one round of the search counts: numbers, and two bytes of text.
BINS, DIGITS = 1000, 4


def order_key(df: DataFrame, column: str) -> tuple[Column, bool]:
    """(a key in the order of ``column``, is it text?).  Numbers stand for
    themselves, times for their microseconds, text and bytes for their bytes
    in hexadecimal."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return c, False
    if isinstance(kind, T.BooleanType):
        return c.cast("int"), False
    if isinstance(kind, T.DateType):
        return F.unix_date(c), False
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c), False
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c), False
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.hex(c.cast("binary")), True
    raise SourceError(f"rows cannot be ordered by {column} ({kind.simpleString()})")


def cut_key(keys: DataFrame, n: int, text: bool = False):
    """(value, ties): the n-th smallest value of the column ``k`` (without
    nulls) and how many rows of that very value belong to the first ``n``; None
    if there are fewer rows.

    Counts of ranges narrow the search down until few keys are left: ranges of
    equal width for numbers, the next two bytes after the common prefix for
    text (a radix search).  The driver sees the counts of one round at a time."""
    need = n
    while True:
        lo, hi, rows = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
        if rows < need:
            return None
        if lo == hi:
            return lo, need
        if rows <= EXACT_ROWS:
            value = keys.orderBy("k").limit(need).agg(F.max("k")).first()[0]
            return value, need - keys.where(F.col("k") < F.lit(value)).count()
        if text:
            shared = next((i for i, (x, y) in enumerate(zip(lo, hi)) if x != y), min(len(lo), len(hi)))
            at = F.substring("k", shared + 1, DIGITS)
        else:
            exact = isinstance(lo, int)
            k = F.col("k").cast("decimal(38,0)") if exact else F.col("k").cast("double")
            offset = (k - F.lit(lo).cast("decimal(38,0)" if exact else "double")).cast("double")
            width = float(hi - lo) / BINS
            at = F.least(F.floor(offset / F.lit(width)), F.lit(BINS - 1))
        for b, count in sorted(tuple(r) for r in keys.groupBy(at.alias("b")).count().collect()):
            if need <= count:
                keys = keys.where(at == F.lit(b))
                break
            need -= count


def sample_limit(df: DataFrame, n: int, order_by: str = KEY) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (a number, time, text or bytes),
    nulls last (S2).

    An unordered ``LIMIT`` is not repeatable and an ordered one sends all n
    rows through one task.  Here the n-th key is found from distributed
    counts, and the rows are filtered by it where they are; only rows that
    share the n-th key (or have none) are cut by a plain limit."""
    if n < 1:
        return df.limit(0)
    key, text = order_key(df, order_by)
    cut = cut_key(df.where(key.isNotNull()).select(key.alias("k")), n, text)
    if cut is None:
        some = df.where(key.isNotNull())
        return some.unionByName(df.where(key.isNull()).limit(max(0, n - some.count())))
    value, ties = cut
    if df.where(key == F.lit(value)).limit(ties + 1).count() == ties:
        return df.where(key <= F.lit(value))
    return df.where(key < F.lit(value)).unionByName(df.where(key == F.lit(value)).limit(ties))


def source_row_count(spark: SparkSession, path: str, schema: T.StructType,
                     required: Sequence[str] | None = None, line_breaks: bool | None = None) -> DataFrame:
    """File name, well-formed and malformed rows of a CSV source, without
    storing it (S3).

    A bare ``count()`` would not parse the rows at all (the reader skips
    parsing when no column is needed), so malformed rows would be counted.
    Instead every parsed row goes to the ``noop`` sink, which consumes all
    columns and stores nothing, and an ``Observation`` on that single pass
    counts both kinds.
    """
    raw = read_csv(spark, path, schema, required, line_breaks)
    obs = Observation("csv_count")
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    raw.observe(obs, F.count_if(~bad).alias("row_count"), F.count_if(bad).alias("malformed_rows")) \
        .write.format("noop").mode("overwrite").save()
    got = obs.get
    return spark.createDataFrame([(file_name(path), int(got["row_count"]), int(got["malformed_rows"]))],
                                 "file_name STRING, row_count BIGINT, malformed_rows BIGINT")


def inline_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A literal table (S5): ``createDataFrame(rows, 'a INT, b STRING')``."""
    return spark.createDataFrame(rows, ddl)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan (S9); with ``columns`` only those are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
