import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The folder that all executors share, as a cluster would name it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def texts(spark):
    """Documents with null, empty, repeated and odd rows, and columns whose names clash with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, -1, "x", 7) for i, t in rows], "doc_id long, text string, n int, key string, component_id int")

    return make
