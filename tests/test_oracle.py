"""Every registered query equals its SQL twin on the smallest tables."""

import re

import pytest
from oracle_check import connect, differences
from places import SMALL

from hydrolens import catalog
from hydrolens.catalog import all_queries
from oracle.statements import all_statements


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert all_queries().keys() == all_statements().keys()


@pytest.fixture(autouse=True)
def one_set_of_frames(telemetry, monkeypatch):
    """The queries share their records and stored marts; each would store its own otherwise."""
    monkeypatch.setattr(catalog, "Telemetry", lambda spark, sf_dir: telemetry)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_twin(spark, db, name):
    result = all_queries()[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|CartesianProduct", plan)  # stays in the JVM
    assert differences(result, db, all_statements()[name]) == ""
