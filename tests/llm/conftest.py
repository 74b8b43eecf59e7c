import pytest

from tests.conftest import SF_MID, SF_SMALL, spark  # noqa: F401

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(60))

#: Nulls in every column, empty and blank and very long texts, one-word and one-line texts, ties, repeated rows.
EDGE = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 10),
    (2, "Alpha  BETA gamma\tdelta epsilon zeta eta theta iota kappa ", "en", "a", 10),
    (3, "", "en", "b", 0),
    (4, None, None, None, None),
    (5, "one", "de", "b", 3),
    (6, " \t\n \x0b\x0c\r ", "fr", "c", 7),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG + " tail", "en", "a", len(LONG) + 5),
    (9, PASSAGE + " first ending here", "en", "c", 1),
    (10, "opening words " + PASSAGE, "en", None, 1),
    (11, "one", "de", "b", 3),
    (11, "one", "de", "b", 3),
    (12, "ÀÉ ñ 漢字 𝔘 mixed\nsecond line\n\nthird", None, "ß", -5),
    (None, "no id at all but words enough to be a document of some kind", "en", "a", 1),
    (None, None, None, None, None),
    (13, "same line\nother thing\nSAME line  \nlast", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):  # noqa: F811
    """The edge rows with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA)
    for c in ("id", "row", "size", "key", "gone", "n", "parts", "component_id", "source2", "range", "copies", "line"):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def empty(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def mid_dir():
    return SF_MID
