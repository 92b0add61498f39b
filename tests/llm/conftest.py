import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for what they add.
        T.StructField("size", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("stats", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("shard", T.StringType()),
    ]
)
WORDS = [a + b + c for a in ("ba", "ke", "li", "mo", "ru") for b in ("n", "s", "t", "ll") for c in ("a", "er", "o", "ing", "um")]


def words(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(count))


def cases() -> list[tuple]:
    """Null and empty texts, null ids and columns, one word, a very long text, repeated rows, ties, copies."""
    long = words(1, 30_000)
    near = words(2, 120)
    texts = [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, "word"),
        (4, "four words are few"),
        (5, long),
        (6, long + " and a little more"),
        (7, near),
        (8, near),
        (9, near.replace(" ", "  ").upper()),
        (10, near + " with an end"),
        (11, words(3, 60)),
        (11, words(3, 60)),
        (None, words(4, 50)),
        (None, near),
        (13, "é" * 50 + " 123 " + "z" * 300_000),
        (14, "mail a.b@c.example.org or +1 (974) 555-3436, 4845168114407329 and 10.0.0.1."),
        (15, "7536784127813050 4845168114407329 is one card behind another number"),
    ]
    return [(i, t, None if i == 3 else "en", None if i == 4 else "web", None if t is None else len(t), *["x"] * 6) for i, t in texts]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(cases(), DOCS).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
