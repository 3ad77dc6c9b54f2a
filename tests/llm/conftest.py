import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # names that operators use for their own columns
                     T.StructField("id", T.StringType()), T.StructField("fp", T.StringType()),
                     T.StructField("a.b", T.StringType()), T.StructField("score", T.StringType())])

EDGES = [
    (1, None), (2, ""), (3, "   \n\n \t"), (4, "one"), (5, "Same Text here, twice."), (6, "same text HERE, twice."),
    (6, "same text HERE, twice."), (7, "É same text"), (8, "é same text"), (None, "no id"), (None, None),
    (9, "word " * 30_000), (10, "x" * 3_000), (11, "a  b　c\x1cd\n\n\ne <|endoftext|> don't 1,234½"),
    (12, "mail me: first.last@mail.example.com or +1 (974) 555-3436, 192.168.0.255"),
]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with the columns of the table and more, from (doc_id, text[, source]) tuples."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else (None if i % 4 == 0 else f"s{i % 4}"), None, "x", "y", "z", "w")
                for i, r in enumerate(rows)]
        return spark.createDataFrame(full, DOCS)
    return build


@pytest.fixture(scope="session")
def edges(frame):
    return frame(EDGES)


@pytest.fixture(scope="session")
def none(frame):
    return frame([])
