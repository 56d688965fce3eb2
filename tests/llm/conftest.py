import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, key string, host string, shard int, block int, row long, length string"


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def documents(spark):
    """Documents from texts (numbered from 0) or (doc_id, text, source) rows, with columns whose names operators use inside."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "s1") for i, r in enumerate(rows)]
        rows = [(i, t, "en", s, len(t or ""), "x", "y", "z", -1, -2, -3, "w") for i, t, s in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make
