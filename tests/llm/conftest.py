import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Columns that clash with names the operators use themselves.
CLASHING = "keys STRING, digest INT, h STRING, _copy_id STRING, _leak_id INT, node INT, host INT, tokens STRING"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text) rows, with other columns, some named as inner ones."""

    def make(rows):
        extra = ("k", 1, "h", "c", 2, 3, 4, "t")
        return spark.createDataFrame(
            [(i, t, "en", None, None, *extra) for i, t in rows],
            f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {CLASHING}",
        )

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tied, repeated and very long texts."""
    words = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "  \t\n"), (4, "one two"), (5, "one  two"), (6, "One two"),
        (7, words), (8, words + " tail"), (9, "a b c d e f g h i j"), (9, "a b c d e f g h i j"),
        (10, "é ñ 你好 😀 a\tb"), (None, "one two"), (11, "x" * 5000),
    ]
