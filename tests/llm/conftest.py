import pytest
from pyspark.sql import Row

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) tuples."""
    def make(rows):
        full = [Row(doc_id=r[0], text=r[1], lang=r[2] if len(r) > 2 else None, source="s",
                    n_chars=len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame([tuple(r) for r in full], DOC_SCHEMA)
    return make
