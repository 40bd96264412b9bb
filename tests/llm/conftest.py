import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, fp string, words string"


@pytest.fixture
def documents(spark):
    """A table of documents from texts or (doc_id, text) pairs, with further columns under names of the operators."""

    def build(texts, lang="en", source="s"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, source, None if t is None else len(t), "r", "f", "w") for i, t in pairs]
        return spark.createDataFrame(rows, COLUMNS)

    return build


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {row.doc_id: row.text for row in corpus.select("doc_id", "text").collect()}
