import pytest
from pyspark.sql import functions as F

from civitally.workspace import Workspace

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def ws(spark):
    with Workspace(spark, "llm-test") as space:
        yield space


@pytest.fixture
def docs_of(spark):
    """Documents from texts, or from (doc_id, text) or fuller tuples."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            full.append(row + (None, None, None)[: 5 - len(row)] if len(row) > 2 else (*row, "en", "src0", None))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clashing(docs_of):
    """Add columns whose names an operator is likely to use itself."""

    def add(docs):
        names = ["component_id", "fp", "text_key", "block", "length", "bin", "score", "n_hit", "uid", "kind", "island"]
        return docs.withColumns({n: F.lit("clash") for n in names})

    return add


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
