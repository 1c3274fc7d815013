import pytest

from eventloom.llm import licences, secrets


@pytest.fixture(scope="session")
def forest(spark):
    return secrets.standard_forest(spark)


@pytest.fixture(scope="session")
def classifier(spark):
    return licences.standard_classifier(spark)
