"""Small tables with the awkward rows that every operator must take."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    def make(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, g, "src", None if t is None else len(t)) for i, t, g in zip(ids, texts, langs, strict=True)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def awkward():
    """Null, empty, blank, repeated, very long and non-ASCII texts."""
    return [None, "", " \n\t ", "one", "one", "a b c d e f g", "word " * 30_000, "x" * 30_000, "é漢😀 mañana\r\nÜber", "tab\tand\x0bvt"]
