import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A function that makes a documents table of (doc_id, text, lang) rows, with clashing extra columns."""

    def make(rows):
        rows = [(*r, *[None] * (3 - len(r))) for r in rows]
        return spark.createDataFrame(
            [(i, t, lang, "s", len(t or ""), "x", 1) for i, t, lang in rows],
            "doc_id long, text string, lang string, source string, n_chars long, digest string, length int",
        )

    return make
