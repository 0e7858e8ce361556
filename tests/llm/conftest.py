import pytest

pytest.importorskip("tidemark.llm")


@pytest.fixture
def docs(spark):
    """A documents table from texts, or from (id, text) pairs."""

    def make(rows):
        rows = [row if isinstance(row, tuple) else (n, row) for n, row in enumerate(rows)]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    return make
