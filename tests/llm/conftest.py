import pytest
from pyspark.sql import functions as F

from rollcall.llm.common import shipped

#: Names the operators use inside, as columns of the given table.
CLASHING = [
    "_id", "_row", "_run", "_text", "_print", "_digest", "_sha", "_size", "_n", "_first", "_part",
    "_source", "_score", "_clean", "_found", "_new", "_key", "_rule", "part", "ahead", "ids",
    "kept", "score", "spans", "rule", "host", "path", "verdict", "fingerprint", "component_id",
    "keep_id", "start", "length", "sequence_id", "offset", "held_out", "predicted",
]
LONG = "".join(f"Word{i % 97} then, {i % 11}.\n" for i in range(20_000))
TEXTS = [
    (1, "The same text of a few words, here."), (2, "The  same text\tof a few words, here."),
    (3, "The same text of a few words, here."), (3, "The same text of a few words, here."),
    (None, "The same text of a few words, here."), (None, None), (4, None), (5, ""), (6, " \n\t "),
    (7, "one"), (8, "one two"), (9, LONG), (10, LONG + "x"), (11, "é " * 500),
    (12, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and 4111 1111 1111 1111'),
    (13, "日本語のテキスト。 次の文。"),
]


@pytest.fixture(scope="session")
def shipping(spark):
    return shipped(spark)


@pytest.fixture(scope="session")
def awkward(shipping):
    """Nulls, empty and long texts, ties, repeated rows, and names that clash."""
    rows = [(i, t, None if i == 7 else f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in TEXTS]
    df = shipping.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
