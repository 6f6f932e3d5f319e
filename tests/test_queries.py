"""Every registered query beside its SQL at the smallest scale."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_module
from earshot.plans import registry

PLANS, SQL = registry.PLANS, registry.SQL


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(PLANS))
def test_query(name, spark, con, sf):
    assert differences(PLANS[name](spark, sf), con, SQL[name]) == []


def test_every_query_has_sql():
    assert PLANS.keys() == SQL.keys()


def test_entry(spark):
    rows = entry_module.entry(spark).orderBy("rank").take(1)
    assert (rows[0].track_id, rows[0].total_plays, rows[0].total_listening_time_ms) == ("track_26", 18, 2_843_050)
