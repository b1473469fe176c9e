"""Every query with an SQL twin gives the twin's names, types, rows and values."""

import pytest

import __spark_entry__ as E
from checker import compare, connect
from fareweave.plans.oracle import ORACLES
from fareweave.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
ROWS_ONLY = {
    "trn_compare", "trn_run_log", "sco_model_card", "sco_model",
    "trn_ols", "trn_ridge", "trn_forest", "trn_gbt", "trn_gbt_alt",
}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_is_checked():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    assert compare(duck, E.oracle_sql()[name], E.queries()[name](spark, FOLDER)) == []


@pytest.mark.parametrize("name", ["trn_run_log", "sco_model_card", "sco_model"])
def test_rows(spark, name):
    assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    assert E.entry(spark).count() == 21
