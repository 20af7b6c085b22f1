import pytest

LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, an extra column."""
    rows = [
        (1, "Alpha beta gamma.\nAlpha beta gamma.", "en", "a", 10, "x"), (1, "Alpha beta gamma.\nAlpha beta gamma.", "en", "a", 10, "x"),
        (2, None, None, None, None, None), (3, "", "en", "a", 0, "y"), (4, LONG, "en", "a", len(LONG), "z"), (None, "no id here", "en", None, 3, "z"),
        (5, "Ünïcode space   tabs\tand\x0bmore <|endoftext|> ok", "fr", "b", 9, "w"), (6, " \n\t ", "en", "b", 4, "w"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
