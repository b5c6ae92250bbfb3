import pytest

LONG = "word " * 60_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and extra
    columns named like those the operators use inside."""
    rows = [
        (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s", 1),
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "xx", "s", 4),
        (4, LONG, "en", "s", len(LONG)), (5, "same text here " * 8, "en", "s", 120), (5, "same text here " * 8, "en", "s", 120),
        (6, "same text here " * 8, "en", "s", 120), (7, "x" * 100_000, "en", "s", 100_000),
        (8, "▁ naïve \U0001f600 <|im_end|> café 你好", None, "s", 20), (None, "tail", "en", "s", 4),
    ]
    rows = [(*r, 1, 2, "n", "k", [1]) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "fp long, root long, print string, base string, words array<int>")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
