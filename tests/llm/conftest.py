import pytest

from martlens.testing import duck_connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    return duck_connect(SF)


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names operators use inside."""
    def make(rows, lang="en", source="a"):
        return spark.createDataFrame(
            [(i, t, lang, source, len(t) if t else 0, "x", 1, 2) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, component string, n int, size int")
    return make
