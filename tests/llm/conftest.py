import pytest
from cases import AWKWARD, SCHEMA


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank, equal, repeated, very long and odd texts, with columns that clash with results."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    extra = ["score", "predicted", "lang_pred", "rejected", "ids", "size", "taken", "n_words", "votes", "quality", "n", "fp", "id", "_text", "coverage", "component_id"]
    return df.withColumns({c: F.lit("clash") for c in extra})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
