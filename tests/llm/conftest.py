import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long, row string, hash string"


@pytest.fixture
def odd_docs(spark, docs_schema):
    """Nulls, empty, blank and long texts, ties, repeated rows, and extra columns with clashing names."""
    texts = [None, "", " \n\t ", "one", "one", "x" * 30_000, "ab cd " * 3_000, "Ünïcödé 漢字 🙂 <|endoftext|>", "a  b \n c", None]
    rows = [(i, t, "en" if i % 2 else None, None, i, "r", "h") for i, t in enumerate(texts)]
    rows += [(3, "one", "en", None, 3, "r", "h"), (None, "one", None, None, None, None, None)]
    return spark.createDataFrame(rows, docs_schema)


@pytest.fixture
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)
