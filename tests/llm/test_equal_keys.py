"""Rows of one id and text that differ in other columns are one document."""

import pytest
from small import frame

from strata.llm import substrings


@pytest.mark.parametrize("crowded", [10_000, 1])
def test_rows_of_one_id_and_text_keep_their_words(spark, crowded):
    text, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, text, "en", "web", 1), (1, text, "en", "books", 1), (None, other, "en", "web", 1), (None, other, "de", "books", 1), (2, text, "en", "web", 1)]
    docs = frame(spark, rows, False).repartition(5)
    got = [(r["doc_id"], r["source"], r["text"]) for r in substrings.deduplicate(docs, crowded=crowded).collect()]
    want = [(1, "web", text), (1, "books", text), (None, "web", other), (None, "books", other), (2, "web", "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
