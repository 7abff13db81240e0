import random

import pytest

from tablewright.llm import common

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Missing ids and texts, empty, repeated and very long rows, and columns with clashing names."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "x1", "ü"]) + str(rng.randrange(999)) for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "no id here"), (5, long), (6, long + " end"),
            (7, "a" * 1_000), (7, None), (8, "\x00\x01 odd \U0010fffd chars ▁ <|endoftext|> \\ <|im_end|>")]
    wide = [(i, t, "row", 0, "h", b"s", "u", [1]) for i, t in rows]
    return spark.createDataFrame(
        wide, "doc_id long, text string, row_key string, n int, hash string, set_key binary, unit string, runs array<int>")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
