from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def spark():
    from shelfmark.session import local_session

    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    from checks.views import Views

    return Views(spark, SMALL)


@pytest.fixture(scope="session")
def rev(views):
    from shelfmark.plans import facts

    return facts.revenue_lines(facts.order_lines(views.items(), views.orders()))
