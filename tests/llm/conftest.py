import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples."""
    def make(rows, extra=""):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
        width = 5 + len([x for x in extra.split(",") if x.strip()])
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(full, schema)
    return make
