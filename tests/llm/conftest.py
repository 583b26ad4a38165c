import pytest

from tests.llm.helpers import documents, odd_rows


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns whose names operators use inside."""
    df = documents(spark, odd_rows())
    for name in ("stats", "verdict", "language", "cleaned", "header", "directory", "entries", "doc_key", "node", "keys", "count"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.cache()


@pytest.fixture
def tables(spark, folder):
    """Writes frames as the tables of a folder and gives its path."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write
