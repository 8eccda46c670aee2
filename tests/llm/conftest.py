import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"

# Rows that every operator on documents must take: nulls in any column, empty
# and blank texts, repeated rows, one id with two texts, a very long text, and
# extra columns whose names clash with working names.
LONG = " ".join(f"word{i % 977} und{i % 13}" for i in range(40_000))
EDGE = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.\nSecond line of some words here.", "en", "s1", 10),
    (1, "Alpha beta gamma delta epsilon zeta eta theta.\nSecond line of some words here.", "en", "s1", 10),
    (1, "another text under the same id", "en", "s2", 10),
    (2, None, "en", "s1", None),
    (3, "", None, None, 0),
    (4, " \t\n\x0b\x0c\r ", "de", "s2", 7),
    (None, "a text without an id but with words", "fr", "s3", 3),
    (None, None, None, None, None),
    (5, LONG, "en", "s1", len(LONG)),
    (6, "Été ÀÉ İstanbul ẞtraße naïve word 漢字 \U0001f600 smile", "fr", None, 5),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("fp", "key", "u", "mix_info", "features", "line_drops", "simhash_row", "license_text", "row", "kept")


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return docs.select("doc_id", "text", "source").orderBy("doc_id").collect()


@pytest.fixture(scope="session")
def queries():
    import __spark_entry__

    return __spark_entry__.queries()
