import pytest

from .helpers import CLASHING, DOC_SCHEMA, awkward_rows


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and further columns with clashing names."""
    df = spark.createDataFrame(awkward_rows(), DOC_SCHEMA).repartition(3)
    return df.selectExpr("*", *(f"{value} AS `{name}`" for name, value in CLASHING.items())).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
