import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside, in other cases too.
        T.StructField("_text", T.StringType()),
        T.StructField("_KEY", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("_grams", T.IntegerType()),
        T.StructField("size", T.StringType()),
        T.StructField("_toxicity", T.StringType()),
        T.StructField("_benchmark_match", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None):
        rows = [
            (i, t, "en", "src0", None if t is None else len(t), "x", "y", "z", 1, "s", "t", "b")
            for i, t in zip(ids or range(len(texts)), texts, strict=True)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def words():
    def make(n, seed, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return make


@pytest.fixture(scope="session")
def edge_texts(words):
    """Null, empty, blank, short, very long, equal and near-equal texts."""
    long = words(60_000, 1)
    return [None, None, "", "", "   ", "?!", "one", "two words", long, long + " end", words(80, 2), words(80, 2), words(80, 3), "é日本 ß", "\x00\x01 a"]
