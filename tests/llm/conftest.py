import pytest
from pyspark.sql import types as T

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "the QUICK brown fox jumps over the lazy dog near the old river bank today"),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (6, "one two"),
    (7, "a shared line that is surely long enough\nand a second line of this text"),
    (8, "  A shared line that is surely LONG enough\t\nunlike the others in all respects"),
    (9, "x\na shared line that is surely long enough\na shared line that is surely long enough\ny"),
    (9, "x\na shared line that is surely long enough\na shared line that is surely long enough\ny"),
    (None, "a shared line that is surely long enough\nof nobody"),
    (10, "word " * 3000 + "end"),
    (11, "日本語のテキスト 😀 emoji   spaces   and\r\nbreaks"),
    (12, "12345 67890 !!! ###"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank, repeated and long texts, with extra columns named as the operators' own."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("language", T.StringType()), T.StructField("n_lines", T.StringType()),
        T.StructField("measures", T.IntegerType()), T.StructField("quality", T.IntegerType()),
    ])
    return spark.createDataFrame([(i, t, "kept", "kept", 7, 8) for i, t in TEXTS], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
