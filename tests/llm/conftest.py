import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(texts, extra=""):
        rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)] if not isinstance(texts, dict) else [
            (k, t, "en", "src0", len(t or "")) for k, t in texts.items()
        ]
        return spark.createDataFrame(rows, COLUMNS)

    return make


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    rows = [
        (1, "one two three", "en", "a", 13, "x", 1, 0.5),
        (1, "one two three", "en", "a", 13, "x", 1, 0.5),
        (2, "one two three", None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 1, 0.5),
        (4, None, "en", "b", 0, "x", 1, 0.5),
        (None, "no id", "en", "b", 5, "x", 1, 0.5),
        (None, "no id", "en", "b", 5, "x", 1, 0.5),
        (None, None, None, None, None, None, None, None),
        (5, "long " * 60_000, "en", "a", 300_000, "x", 1, 0.5),
        (6, "x" * 200_000, "en", "a", 200_000, "x", 1, 0.5),
        (7, " \n\t ", "en", "a", 4, "x", 1, 0.5),
        (8, "Ünï çödé 日本語 😀\n\nsecond paragraph.", "en", "a", 30, "x", 1, 0.5),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, recipe string, fp int, score double"
    return spark.createDataFrame(rows, names)
