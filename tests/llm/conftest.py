import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with columns whose names clash with those that operators add."""
    def build(rows, extra=True):
        full = [(i, t, "en", "s", None if t is None else len(t), 7, "x") for i, t in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, component_id string"
        df = spark.createDataFrame(full, names)
        return df if extra else df.drop("n_lines", "component_id")
    return build
