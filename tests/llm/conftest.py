import pytest

FOLDER = "/root/testdata/sf0.001"
# Nulls, empty and blank texts, ties, repeated rows, an id used twice, a very long text.
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ODD = [
    (1, "Alpha beta gamma. " * 30 + PASSAGE, "en", "a", 0),
    (2, PASSAGE + " tail of the second", "en", "a", 0),
    (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n", "en", "b", 3),
    (6, LONG, "en", "b", len(LONG)), (7, LONG, "en", "c", len(LONG)),
    (8, "it's 12 o'clock — don't\n\n  go\tnow  ", "en", "c", 1),
    (8, "it's 12 o'clock — don't\n\n  go\tnow  ", "en", "c", 1),
    (8, "another text under the same id " + PASSAGE, "de", None, 2),
    (None, "no id " + PASSAGE, "fr", "d", 2), (9, "ß É 日本語 🙂 ALPHA", "fr", "d", 2),
    (10, "| | | " * 40 + "\nsame line\nsame line", "fr", "d", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward rows, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(ODD, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("fp", "ids", "kept", "n_words", "_text", "score", "size")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
