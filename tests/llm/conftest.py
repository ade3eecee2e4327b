import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept string, node int, label string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts, with null ids, repeats and columns named like those of results."""
    def build(texts, ids=None, sources=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(doc_id, text, (langs or {}).get(at), (sources or {}).get(at, "s"), None, 1, "x", 2, "y")
                for at, (doc_id, text) in enumerate(zip(ids, texts, strict=True))]
        return spark.createDataFrame(rows, SCHEMA)
    return build


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
