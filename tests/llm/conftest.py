import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, key string, fp string, shard int, node int, words string, pos int, digest string"
LONG = " ".join(f"word{k} and the other{k % 50}." for k in range(6000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with names that the
    operators use themselves."""
    extra = (1, "k", "f", 2, 3, "w", 4, "d")
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, LONG, "en", "b", len(LONG)), (5, "One short text.", "en", "b", 15), (5, "One short text.", "en", "b", 15),
        (6, "one  SHORT text.", "en", "b", 16), (None, "no id here at all", "de", "c", 5), (7, "12 34 !!", "en", "c", 8), (8, "ñandú é 👩‍👩‍👧 x", "es", "c", 9), (9, LONG, None, "b", 3), (10, "x" * 500, "xx", "d", 500),
    ]
    return spark.createDataFrame([r + extra for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
