import pytest


@pytest.fixture(scope="session", autouse=True)
def _workers_find_the_package(spark):
    from vigil.llm.common import importable
    importable(spark)
