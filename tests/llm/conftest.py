import pytest

from cohortlens.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)
