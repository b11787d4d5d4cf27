import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def texts(oracle):
    return oracle.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, a clashing extra column."""
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [
        (1, "", "en", 5),
        (2, None, None, None),
        (None, "a line\nanother line", "en", 1),
        (3, long, "de", 2),
        (4, long, "de", 2),
        (4, long, "de", 2),
        (5, "one two\n\n  One Two \n", None, 3),
        (6, "\n\n", "fr", 4),
        (7, "été ▁   \U0001f600 " + "x" * 5000, "fr", 4),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
