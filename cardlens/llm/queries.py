"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import read_table, ship_package
from .oracle import SQL


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file (an installed package on every node)."""
    import public_tokenizers
    return public_tokenizers.path(name)


WORD_BPE = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import op1
    return op1(read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op2_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import op2
    return op2(read_table(spark, sf_dir, "conversations"), vocabulary(BYTE_RANKS))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cotrain import op3
    return op3(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import build_lexicon, digests, encode
    docs, path = read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE)
    return digests(encode(docs, path, build_lexicon(docs, path)), path)


def op5_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import op5
    return op5(spark, read_table(spark, sf_dir, "pages"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import op6
    return op6(read_table(spark, sf_dir, "documents"))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linerules import assess
    return assess(read_table(spark, sf_dir, "documents"))


def op8_segment_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import op8
    return op8(read_table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op9_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bitpack import op9
    return op9(spark, read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op10_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import op10
    return op10(read_table(spark, sf_dir, "documents"))


def op11_identity_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .align import op11
    return op11(read_table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECES))


def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import op12
    return op12(read_table(spark, sf_dir, "documents"))


def op13_window_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .doubling import op13
    return op13(spark, read_table(spark, sf_dir, "documents"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: shipped(f) for f in (op1_length_buckets, op2_chat_tokens, op3_cotraining, op4_transducer_bpe, op5_warc_dictionary, op6_minhash, op7_line_rules, op8_segment_language, op9_bit_packing, op10_signature_trees, op11_identity_alignment, op12_merkle_versions, op13_window_doubling)
}

ORACLE_SQL: dict[str, str] = SQL
