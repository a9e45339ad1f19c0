import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, source)`` rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_docs(docs_of):
    """Nulls, empty, blank and very long texts, repeated rows, equal texts, and ids that are missing."""
    long_text = " ".join(f"word{k % 997} and" for k in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "A b C"), (5, "a B c"), (5, "a B c"), (None, "a b c"), (7, long_text), (8, "one"), (9, "é ß \x0b x")]
    return docs_of([(*r, None if r[0] == 8 else "s") for r in rows])


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
