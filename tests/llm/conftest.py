import pytest

from llm_helpers import documents


@pytest.fixture(scope="session")
def edge(spark):
    """NULL id and text, empty, blank and very long texts, repeated rows and ties."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = [None, "", " \n\t", "é", word, word, "x" * 120_000, (word + "\n") * 3_000, "one two", "one two", word.upper(), "ok"]
    ids = [None, 1, 2, 3, 4, 5, 6, 7, 8, 8, 10, None]
    return documents(spark, texts, ids)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture
def table(small, spark):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")
