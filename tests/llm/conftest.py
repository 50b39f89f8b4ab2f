import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
#: Names that the operators use themselves.
CLASHING = ["score", "lang_pred", "key", "id", "th", "starts", "bin", "share", "rate", "dropped", "component_id", "ids"]


def prose(seed: int, n: int, words: int = 400) -> str:
    """Invented words in an order that the seed fixes."""
    state, out = seed * 2654435761 % 2**32 or 1, []
    for _ in range(n):
        state = (state * 1664525 + 1013904223) % 2**32
        out.append("w" + "aeiou"[state % 5] + str(state >> 8)[:3] + "n" * (state % 3) + str((state >> 16) % words))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    a, b = prose(1, 60), prose(2, 60)
    return [
        (1, a, "en", "s0", 1), (2, a, "en", "s0", 1), (2, a, "en", "s0", 1), (3, a + " end", "en", "s1", None),
        (4, "", "en", None, 0), (5, None, None, "s0", None), (None, b, None, None, None), (None, None, None, None, None),
        (6, b, "de", "s2", 5), (7, "!!! ... ???", "de", "s2", 5), (8, "été 日本語 \U0001f600   x", "fr", "s0", 5), (9, prose(3, 30_000), "en", "s0", 5),
        (10, "one", "en", "s0", 3), (-3, " \t\n ", "en", "s0", 3), (11, "a b " * 200, "en", "s0", 800),
        *((20 + i, prose(50 + i, 90), ("en", "de")[i % 2], f"s{i % 4}", 9) for i in range(20)),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, DOCS)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"cast(null as string) as {name}")
    return frame


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
