import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with the table's other columns."""
    def build(pairs, extra=""):
        rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for name in extra.split():
            df = df.selectExpr("*", f"doc_id AS {name}")
        return df
    return build
