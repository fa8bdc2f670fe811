import pytest
from pyspark.sql import types as T

from kpiloom.llm.spark import prepare

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # columns whose names the operators also use inside
                     T.StructField("id", T.StringType()), T.StructField("version", T.StringType()), T.StructField("node", T.StringType())])


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y", "z") for i, t in rows], DOCS)
    return make


LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))

#: Null ids and texts, empty and blank texts, one word, repeated rows, a repeated id, a very long text.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Alpha beta gamma"), (5, "Alpha beta gamma"), (6, "alpha beta gamma"),
         (None, "alpha beta gamma"), (7, LONG), (8, LONG), (9, "x" * 5000), (10, "é ü ß 漢字"), (11, "a\x0bb\x0cc\r\nd")]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGES)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
