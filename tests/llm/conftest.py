import pytest

EXTRA = "hash long, component string, words string, n int, body string, key string, pieces string, n_pieces int, " \
        "language string, language__ string, mixed_id int, `meta.url` string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang, source]), with columns whose names operators use inside."""
    def build(*rows):
        full = [(*row, *(None, "s")[len(row) - 2:], 1, "c", "w", 2, "b", "k", "p", 3, "l", "l", 4, "u") for row in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, {EXTRA}")
    return build
