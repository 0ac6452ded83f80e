"""A fixture that the tests of this folder share."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `copy` string, `row` int"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with further columns whose names clash with the operators' own."""

    def make(*pairs):
        rows = [(i, t, None, "s", None if t is None else len(t), "x", 1) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make
