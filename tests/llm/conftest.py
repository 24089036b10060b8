import contextlib
import io

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType())])

LONG = "word " * 60_000 + "\n" + "x" * 200_000

EDGE = [
    (1, "alpha beta gamma delta epsilon", "en", "a", 30), (2, "alpha beta gamma delta epsilon", "en", "b", 30),
    (2, "alpha beta gamma delta epsilon", "en", "b", 30), (3, None, None, None, None), (4, "", "en", "a", 0),
    (5, " \t\n ", "fr", None, 4), (None, "alpha beta gamma delta epsilon", "en", "a", 30), (None, None, None, "a", None),
    (6, LONG, "de", "c", len(LONG)), (7, "Ünïcode ÄÖ 漢字 🙂 é\x1c\x1fz", "de", "c", 20), (8, "one", "en", "a", 3),
    (9, "mail bob.17@host.example.com or +1 (212) 555-0199\nl1\nl2\nl3", "en", "a", 50),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="session")
def word_bpe():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_bpe():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """The Python workers import the package too, from whatever folder pytest was started in."""
    from visitlens.session import ship_package
    ship_package(spark)


def explain_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
