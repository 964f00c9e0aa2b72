import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while a small bird sings in the old tree by the river"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=True):
        """Documents from (doc_id, text, lang, source) rows, with columns that no operator should trip over."""
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            df = df.selectExpr("*", "1 as node", "'x' as doc", "2 as `__n`", "'y' as size", "3 as `a.b`")
        return df

    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    rows = [
        (0, None, None, None),
        (1, "", "en", "a"),
        (2, " \n\t ", "en", "a"),
        (3, "... 123 !!", "en", "b"),
        (4, PROSE, "en", "b"),
        (4, PROSE, "en", "b"),
        (5, PROSE.upper(), "en", None),
        (6, PROSE + " tonight", None, "a"),
        (7, "été à la plage où les enfants jouent avec le sable 😀 près de la mer", "fr", "c"),
        (8, "one two", "en", "c"),
        (9, "One  two", "en", "c"),
        (None, "a row without an id says password: hunter2hunter2", "en", "c"),
        (11, PROSE * 3000, "en", "a"),
        (12, "x" * 20000, "en", "a"),
    ]
    return make_docs(rows)
