"""Every named query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from demandkit.operators.serve import ORDER_COLUMNS
from demandkit.plans import queries as plans
from demandkit.plans.oracle import oracle_sql
from demandkit.plans.queries import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, connection, name):
    assert differences(contract.queries()[name](spark, sf), connection, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())


def test_queries_without_sql_are_the_iterative_ones():
    assert set(QUERIES) - set(SQL) == {"gbt_forecast"}


def test_entry_has_the_order_table_columns(spark):
    assert contract.entry(spark).columns == list(ORDER_COLUMNS)


def test_boosted_trees_serve_every_pair(spark, sf):
    orders = contract.queries()["gbt_forecast"](spark, sf)
    assert orders.columns == list(ORDER_COLUMNS)
    assert orders.count() == contract.queries()["order_plan"](spark, sf).count()
    assert orders.filter("tomorrow_order_qty is null or next7_order_qty is null").isEmpty()


def test_invoice_documents_are_compressed(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "fresh_path", lambda spark, purpose: str(tmp_path / purpose))
    n = contract.queries()["invoice_flatten"](spark, sf).count()
    written = sum(f.stat().st_size for f in (tmp_path / "invoices").rglob("part-*"))
    assert 0 < written < 150 * n
