"""Corpus pipeline: language ID, quality classifier, n-gram Jaccard join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.  All but the last return
the columns of ``docs``, in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlens.llm import cotrain, jaccard, language, packing
from cardlens.llm.common import materialize, read_table, ship_package
from cardlens.llm.queries import PIECES, WORD_BPE, vocabulary

#: Bytes of a batch between the JVM and Python: an executor's JVM and workers
#: hold several at a time, besides what four stages have left in them.
BATCH = 4 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters, of no clear
    language, or unlikely in it (other languages, noise) go."""
    ship_package(spark, BATCH)
    return language.identified(docs, vocabulary(PIECES))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    ship_package(spark, BATCH)
    return cotrain.accepted(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents;
    rows without id link with nothing and stay.  Rows that share an id are one
    document here: they link by any of their texts and stay or go together."""
    ship_package(spark, BATCH)
    found = jaccard.op10(docs).where("doc_id != component_id").select("doc_id")
    return docs.join(materialize(found, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of what is left."""
    ship_package(spark, BATCH)
    return packing.op1(docs, vocabulary(WORD_BPE))


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("packing", pack_batches),
]

#: No stage is expressible in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage reads what the one before has written."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
