import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Frame of documents from (doc_id, text[, source]) rows, with columns that clash with
    internal names."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        from pyspark.sql import functions as F
        return spark.createDataFrame(full, DOC_SCHEMA).withColumns({
            "score": F.lit("x"), "shard": F.lit("y"), "ids": F.lit("z"), "kept": F.lit(1),
            "size": F.lit("s"), "__extra": F.lit(2)})
    return make
