import pytest

#: Nulls, blanks, ties, repeated rows, very long texts, and columns whose names clash with inner ones.
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, row int, tok string, _key int"
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(60_000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", None, 5), (None, "no id but words here", "en", "a", 20),
    (4, "one", None, "b", 3), (5, "one", "en", "b", 3), (6, LONG, "en", "b", len(LONG)),
    (7, "the same words again and again in one row", "en", "c", 41), (7, "the same words again and again in one row", "en", "c", 41),
    (8, "1234 5678 !!", "en", "c", 12), (9, "\U0001f600 é ß ŁÓDŹ ​", "fr", "c", 12), (10, "x" * 50_000, "fr", "c", 50_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, "s", 1, "t", 2) for r in ODD]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
