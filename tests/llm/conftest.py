import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text, lang, source) tuples, with an extra column whose name clashes with results."""

    def make(*rows, parts=3):
        full = [(i, r, "en", "s0") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        schema = T.StructType.fromDDL("doc_id long, text string, lang string, source string, score string, kept int, size double")
        return spark.createDataFrame([(*r, "x", 1, 0.5) for r in full], schema).repartition(parts)

    return make
