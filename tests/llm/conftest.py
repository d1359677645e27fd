import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


HARD = [
    (1, None, "en", "a"), (2, "", None, None), (3, "   \n\t", "en", "a"), (4, "1 2 3 !!", "de", ""), (5, "One two", "de", "a"), (5, "One two", "de", "a"),
    (None, "A text without an id, a b c d e f g h", None, "b"), (6, "É" * 3000, "fr", "b"), (7, "word " * 60000, "en", "a"), (8, "x" * 300000, "en", "a"),
    (9, "password=hunter2hunter2 and token: 'abc' a@b.co 10.0.0.1 +1 555 123 4567 4111 1111 1111 1111", "en", "c"), (10, "\x00\x1f \U0001f600  ", "en", "c"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls, empty and very long texts, repeated rows, and further columns named like those the operators make."""
    rows = [(*r, 0.5, 7, "x", "y") for r in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, hash long, doc string, chunk string").repartition(3)


@pytest.fixture(scope="session")
def nothing(hard):
    return hard.where("false")
