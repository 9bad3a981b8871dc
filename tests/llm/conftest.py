import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Small documents table; rows of (doc_id, text, source), with clashing extra columns."""

    def build(rows):
        schema = (
            "doc_id long, text string, source string, lang string, n_chars long,"
            " size long, bucket int, label int, stats string, spans string, rank int"
        )
        return spark.createDataFrame(
            [(*r, "en", len(r[1] or ""), 7, 7, 7, "x", "x", 7) for r in rows], schema
        )

    return build


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
