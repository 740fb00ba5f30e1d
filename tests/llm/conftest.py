import pytest


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_cached_tables_left(spark):
    """Tables that a test caches go with it; later tests look for cached ones left behind."""
    yield
    spark.catalog.clearCache()
