"""Every registered query against its SQL, whole tables, in an independent engine."""

import os

import pytest

from __spark_entry__ import entry
from comparison import connect, differences
from siltstone.plans.oracle import ORACLE_SQL
from siltstone.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engine, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, engine, ORACLE_SQL[name]) == []


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0


JOINING = [
    "enrich_left", "gold_profit_summary", "incremental_gold", "known_orders", "orphan_count",
    "orphans_customer", "quarantine", "silver_order", "upsert_update_insert",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_sql_where_nothing_may_be_broadcast(spark, engine, conf, name):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, engine, ORACLE_SQL[name]) == []
