import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows, parts=3):
        full = []
        for r in rows:
            r = list(r) + [None] * (4 - len(r))
            full.append((r[0], r[1], r[2], r[3], len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture
def as_tables(spark, tmp_path):
    """Write frames as a folder of tables; returns its path."""
    def make(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make


@pytest.fixture
def sf_small():
    return "/root/testdata/sf0.001"
