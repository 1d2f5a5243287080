import os

import pytest




@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names clash with the operators' own."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog " * 30, "en", "a", 1, 0.5, "x"),
        (2, "The quick brown fox jumps over the lazy dog " * 30, "en", "a", 1, 0.5, "x"),
        (2, "The quick brown fox jumps over the lazy dog " * 30, "en", "a", 1, 0.5, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "fr", "b", 0, 0.1, "y"),
        (None, "ein kurzer deutscher Satz ohne Nummer", "de", "b", 0, 0.1, "y"),
        (5, " \t\n\x0b\x0c\r ", "fr", "b", 0, 0.1, "y"),
        (6, "x" * 200_000 + " " + "lang und weit " * 20_000, "de", "c", 0, 0.2, "z"),
        (7, "1234 %% \U0001f600 日本語 \x00 <|endoftext|>  two  spaces\n\n end ", "en", "c", 0, 0.2, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, id string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
