import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id string, _range int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, very long and repeated texts, repeated rows and clashing extra columns."""
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    long = "\n".join(" ".join(words[(i * j + j) % 8] + str((i + j) % 97) for j in range(40)) for i in range(2500))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.\nAgain and again it jumps. " * 6, "en", "a"),
        (2, None, "en", "a"), (3, "", None, "b"), (4, " \t\n ", "fr", None),
        (5, "Le renard brun saute par-dessus le chien paresseux, encore et encore. " * 8, "fr", "b"),
        (5, "Le renard brun saute par-dessus le chien paresseux, encore et encore. " * 8, "fr", "b"),
        (6, long, "en", "c"), (7, "12345 67890 !!! ###", "en", "c"), (8, "x", "en", None),
        (None, "a text without an id " * 30, "en", "a"), (None, None, None, None),
        (9, "é ü  double  spaces\r\nand <|endoftext|> markers 　 x", "fr", "c"),
        (10, "The quick brown fox jumps over the lazy dog.\nAgain and again it jumps. " * 6, None, "a"),
    ]
    return spark.createDataFrame([(*r, None, "s", "c", 3) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
