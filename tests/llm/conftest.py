import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

#: Rows with nulls, empty and long texts, ties and repeats; and columns whose names clash with inner ones.
ODD = [
    (1, "a b c d e f", "en", "s", 1), (2, "A B c d e f", "en", "s", 1), (2, "A B c d e f", "en", "s", 1),
    (3, None, None, None, 1), (4, "", "en", "s", 1), (5, "   \n \t ", "en", "s", 1), (None, "x y", None, "s", 1),
    (None, "x y", "fr", "s", 1), (6, "word " * 5000, "en", "s", 1), (7, "é" * 9000, "fr", "s", 1),
    (8, "中文 text \U0001f600 <|endoftext|> end", "en", "s", 1), (9, "É b c", "fr", "s", 1), (10, "é b c", "fr", "s", 1),
    (11, "tab\tand\r\nline sep\x85nel\xa0nbsp\x1cfs  two  spaces ", "en", "s", 1), (12, "\x00nul", "en", "s", 1),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside.
CLASH = ("key", "piece", "fp", "component", "_salt", "_d", "_t", "_mask", "keep_id", "h", "pos", "length", "n_tokens",
         "score", "item_id", "start", "page_id", "digest", "node")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clash():
    from pyspark.sql import functions as F
    return lambda df: df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
