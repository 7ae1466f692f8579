"""Tables shared by the tests of this folder."""

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white-space texts, copies, near copies, repeated rows, a very long text, clashing extra columns."""
    base = " ".join(f"word{i}" for i in range(120))
    long_text = " ".join(f"w{i * 7919 % 9973}" for i in range(60_000))
    rows = [(0, base, "a"), (1, base, "a"), (2, base.replace("word60", "other"), "b"), (3, None, "b"), (4, "", None), (5, " \t\n", "c"),
            (6, "Three short Words", "a"), (7, "three short words", None), (8, "x" * 50_000, "a"), (9, "Line of more than forty characters, repeated.\n" * 3, "b"),
            (10, long_text, "c"), (11, "intro " + base + " outro", "c"), (None, base, None), (12, "dup row text here now", "a"), (12, "dup row text here now", "a")]
    return spark.createDataFrame([(d, t, s, "id", 1.0, 7) for d, t, s in rows], "doc_id long, text string, source string, id string, score double, size int")
