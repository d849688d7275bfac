"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
CHECKS = oracle_sql()
LAPS = {"st2_geofence_laps", "st2_lap_stream"}  # the smallest tables are too short for a lap: their SQL finds none either; see test_laps.py


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    rows, _, problem = compare(spark, con, SF, name, queries()[name], CHECKS.get(name))
    assert problem is None
    assert rows > 0 or (name in LAPS and CHECKS[name])


def test_entry(spark):
    assert entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(queries())
