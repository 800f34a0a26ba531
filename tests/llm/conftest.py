from __future__ import annotations

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import pytest

#: Null, empty and blank texts, repeated rows, one id twice, a null id, null sources, a long text without
#: white space and one of many words, odd white space, letters beyond the first plane.
ROWS = [
    (1, "One small text, and then some more words to fill it up.", "en", "a", 0),
    (1, "One small text, and then some more words to fill it up.", "en", "a", 0),
    (2, None, "en", "a", 1),
    (3, "", None, None, 2),
    (4, " \n\t ", "de", "b", 3),
    (5, "ab" * 4000, "en", None, 4),
    (6, "many words " * 2000, "en", "c", 5),
    (7, "a b　c\x1cd   \U0001d49c\U0001f600 İstanbul <|endoftext|> don't", "tr", "c", 6),
    (7, "another text under an id that is there already", "en", "a", 7),
    (None, "no id at all", "en", "b", 8),
    (8, "word", "en", "b", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every oddity, and extra columns whose names the operators use themselves."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = spark.createDataFrame(ROWS, kind)
    return rows.selectExpr("*", "1 AS size", "'x' AS id", "2 AS n_tokens", "'y' AS lang_pred", "3 AS row", "'z' AS spans", "4 AS class_id")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
