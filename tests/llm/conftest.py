import re

import pytest
from pyspark.sql import functions as F

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def more_documents(spark):
    return spark.read.parquet(f"{SF_MORE}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an extra column
    named as outputs are."""
    long_text = " ".join(f"w{i % 977} the" for i in range(20_000))
    rows = [
        (0, None, "en", "src0", 0, 1), (1, "", None, "src1", 0, 2), (2, "  \n\t ", "en", None, 4, 3), (3, long_text, "en", "src0", len(long_text), 4),
        (4, "one two three", "en", "src1", 13, 5), (4, "one two three", "en", "src1", 13, 5), (5, "one two three", "de", "src1", 13, None),
        (6, "x" * 50_000, "en", "src2", 50_000, 6), (7, "Été \U0001f600 漢字 ▁ naïve", "fr", "srcé", 9, 7),
        (None, "a row without an id but some words", "en", "src0", None, 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where(F.lit(False))
