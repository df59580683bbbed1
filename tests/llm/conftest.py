from __future__ import annotations

import pytest

TEXT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, chunk long, sequence_id string"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, blank, very long and repeated rows, and columns that clash with those of the operators."""
    long = " ".join(f"word{k % 997} of{k}" for k in range(30_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "One two", "en", None), (5, long, "en", "a"), (6, "a b c d e f g h " * 40, None, "b"), (7, "a b c d e f g h " * 40, "en", "b"), (7, "a b c d e f g h " * 40, "en", "b"), (8, "é è <|im_end|>   x" * 30, "fr", "c"), (None, "no id here at all", "en", "a"), (9, long[:5000] + " changed " + long[5000:], "en", "a")]
    return spark.createDataFrame([(i, t, lang, s, None, 0.5, 7, "x") for i, t, lang, s in rows], TEXT_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TEXT_SCHEMA)
