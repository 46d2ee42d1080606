"""Every query against DuckDB on the smallest data (`python -m checks.compare` does larger ones)."""

from __future__ import annotations

import re

import pytest

from checks import compare, oracle, registry
from shelfmark.operators import ordering
from shelfmark.plans import basket, customers, layers
from shelfmark.sources import files
from tests.conftest import SMALL, physical


@pytest.fixture(scope="module")
def duck():
    return compare.duckdb_tables(SMALL)


def test_every_query_has_sql():
    assert set(oracle.statements()) == set(registry.queries())


# Queries with a window over all rows of a bounded input: one row per range slice, calendar month or
# top-k row.
BOUNDED_WINDOWS = {
    "basket_pairs", "customer_row_number_rank", "ltv_quartiles", "pareto_customers", "product_rank_in_category",
    "yoy_growth", "yoy_growth_dense", "top_customers_ranked", "bottom_customers_ranked", "customer_overall_rank",
}


def check_plan(name: str, plan: str) -> None:
    """No cross join, no Python step and no unbounded global window."""
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    if name not in BOUNDED_WINDOWS:
        assert not re.search(r"Window \[[^\n]*\n(?:[^\n]*\n){0,3}[^\n]*Exchange SinglePartition", plan)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name, monkeypatch):
    """The rows match, and the plan is sound, what stands before a checkpoint included."""
    df = registry.queries()[name](spark, SMALL)
    plan = physical(df)
    check_plan(name, plan)
    fault, _ = compare.differences(df, duck, name)
    assert not fault, fault
    if "ExistingRDD" in plan:
        for module in (ordering, basket, customers, layers, files):
            monkeypatch.setattr(module, "durable", lambda rows: rows)
        whole = physical(registry.queries()[name](spark, SMALL))
        assert "FileScan" in whole
        check_plan(name, whole)
