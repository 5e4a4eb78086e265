from __future__ import annotations

import pytest

from cardlens.llm.common import ship_package

#: Null, empty, blank and very long texts, repeated rows, control characters, other scripts.
ODD_TEXTS = [None, "", " \n\t ", "one", "a b c d", "Hello, World's  ünï 12 <|endoftext|> x! ",
             "áb \x1c x\x1cy  éÉ ǅ İstanbul ½²³ don't 日本語 x日本 ’s it’s ſ ß ẞ “Q” a b <|startoftext|>abc <|",
             "the cat sat on the mat " * 4000, "the cat sat on the mat " * 4000, "x" * 5000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with extra columns whose names clash with results of operators."""
    ship_package(spark)
    rows = [(k, t, "en", f"src{k % 2}", None, 0.5, "clash", 7) for k, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", None, None, None, None, None, None), (None, "no id here at all", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, lang_pred string, part int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def small_docs(spark):
    ship_package(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
