"""Every registered query against independent SQL over the same tables."""

from __future__ import annotations

import check_oracle
import pytest

import __spark_entry__ as registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert check_oracle.compare(spark, con, name, SF) == []


def test_every_sql_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()
    from oracle import ORACLE

    assert ORACLE.keys() <= registry.queries().keys()


def test_entry(spark):
    assert registry.entry(spark).count() > 0
