import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, score double"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]), with extra columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1] or ""), "clash", 1.0) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows of the smallest table, as tuples."""
    import pyarrow.parquet as pq
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in table.to_pylist()]


def tuples(frame, *columns):
    """As in the folder above: ``from conftest import`` finds this module when both are loaded."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)
