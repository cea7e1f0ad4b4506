import pytest
from pyspark.sql import functions as F

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it", "en", "b"),
    (2, "", "en", "b"),
    (3, None, "de", "a"),
    (4, "12 345 ??", None, "a"),
    (5, "Der schnelle braune Fuchs springt über den faulen Hund", "de", None),
    (5, "Der schnelle braune Fuchs springt über den faulen Hund", "de", None),
    (None, "a row without an id but with words enough to hold a shingle", "en", "a"),
    (7, " tabs\tand\x0bother \x1c space   runs \n\n here x", "en", "c"),
    (8, "word " * 40000, "en", "b"),
    (9, "x" * 200000, "en", None),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    df = spark.createDataFrame([(*t, None if t[1] is None else len(t[1])) for t in TEXTS],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("size", "key", "_range", "chunk", "length", "n", "ids", "shard", "rank", "kept", "a", "b", "spans"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def rows(df):
    return [r.asDict() for r in df.collect()]
