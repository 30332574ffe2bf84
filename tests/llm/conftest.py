import pytest
from pyspark.sql import types as T

from plain import prose

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("size", T.StringType()),  # names that operators use inside
        T.StructField("class", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("start", T.StringType()),
    ]
)

def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, odd white space, ties and repeated rows."""
    base = prose(120, 1)
    near = base.replace(base.split()[60], "different", 1)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, prose(90, 2), None, "b"),
        (5, "", "de", None), (6, None, None, None), (7, "one two", "de", "c"), (8, "ONE two", "fr", "c"),
        (9, prose(30_000, 3), "en", "c"), (10, " \n\t ", "en", "a"), (11, "x" * 5000, "en", "a"),
        (None, prose(60, 4), "en", "a"), (None, prose(60, 4), "en", "a"), (12, "é ́ ﬁ ①  \x1c \x85 q  z", "fr", ""),
        (13, "Mail jo.do@mail.example.org or +1 (555) 123-4567, 10.0.0.1 and 4111 1111 1111 1111.", "en", "b"),
        (13, "Mail jo.do@mail.example.org or +1 (555) 123-4567, 10.0.0.1 and 4111 1111 1111 1111.", "en", "b"),
        (14, "Licensed under CC BY-NC 4.0.", "en", "lic"), (15, "日本 語 の 文", None, "lic"), (16, "12345 !!!", "en", "lic"),
    ]
    return [(i, t, lang, s, None, "s", None, "r", "0") for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
