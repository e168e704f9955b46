import pytest


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """A shared folder for tables written between steps, where the session names none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
