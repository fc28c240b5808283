from __future__ import annotations

import pytest

TEXT_COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, with values of no use to them.
CLASHING = ", size int, shard string, node string, component string, key string, part string, doc string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), with columns that clash."""

    def make(rows, clashing=True):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        schema = TEXT_COLUMNS
        if clashing:
            schema += CLASHING
            full = [(*row, 7, "s", "n", "c", "k", "p", "d") for row in full]
        return spark.createDataFrame(full, schema)

    return make


