import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000

ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "a",
    "One Two",
    LONG,
    "same words here in this line again\nsame words here in this line again",
    "same words here in this line again\nsame words here in this line again",
    "naïve café — 東京 ñandú\x0bÜber\x1cx",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts; ``extra`` adds columns that operators use inside."""

    def make(texts, ids=None, langs=None, sources=None, extra=False):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        sources = sources or ["a"] * len(texts)
        rows = [
            (i, t, la, s, len(t) if t is not None else None)
            for i, t, la, s in zip(ids, texts, langs, sources)
        ]
        docs = spark.createDataFrame(rows, DOCS)
        if extra:
            for name in "key k h pos fp size rank draw copies sid score lang_pred tokens row bucket".split():
                docs = docs.selectExpr("*", f"'own' AS {name}")
        return docs

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, long and repeated rows, clashing columns."""
    ids = [0, 1, None, 3, 4, 5, 6, 6, 8]
    sources = ["a", None, "b", "a", "b", "a", "c", "c", None]
    langs = ["en", None, "de", "en", "fr", "en", "en", "en", None]
    return make_docs(ODD_TEXTS, ids, langs, sources, extra=True)
