from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, slot int, host string, _id long, _times int, row string, d1 long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) rows, short rows filled with nulls."""

    def make(rows, clash=False):
        filled = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        if clash:
            filled = [(*r, 1, "k", 2, "h", 3, 4, "r", 5) for r in filled]
        return spark.createDataFrame(filled, CLASH if clash else DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic prose: ``words(seed, n)`` gives n words."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))

    return make
