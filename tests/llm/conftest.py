from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


#: What every operator must bear: nulls, empties, ties, repeats, a long text.
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, "no id at all here we are now"),
    (5, "same text twice over and over again"), (6, "same text twice over and over again"),
    (7, "repeated row with words enough to count"), (7, "repeated row with words enough to count"),
    (8, "long " * 30000), (9, "ünï çödé   \x85 words \U0001f600"), (10, "x", None, None),
]
