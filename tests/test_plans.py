"""What Spark makes of the queries: pruned scans, no Python, no quadratic joins."""

import re

import pytest

from __spark_entry__ import queries
from siltstone.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _plan(spark, name):
    return queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()


# those that run jobs hand out a stored result
JOBS = ("roundtrip", "retail_run", "running_gold", "quarantine_release", "ingest_run")
LAZY = sorted(name for name in QUERIES if not name.endswith(JOBS))


@pytest.mark.parametrize("name", LAZY)
def test_no_quadratic_joins_and_no_python(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name != "xlsx_scan":
        assert "Python" not in plan and "MapInPandas" not in plan


def test_summary_reads_only_what_it_needs(spark):
    plan = queries()["gold_profit_summary"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = dict(re.findall(r"(\w+)\.parquet\].*?ReadSchema: struct<(.*)>", plan))
    columns = {table: re.findall(r"(\w+):", schema) for table, schema in scans.items()}
    assert columns["lineitem"] == ["l_orderkey", "l_partkey", "l_extendedprice", "l_discount"]
    assert columns["customer"] == ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    assert columns["part"] == ["p_partkey", "p_brand", "p_type", "p_size"]


def test_dimension_filters_reach_the_scan(spark):
    plan = _plan(spark, "known_orders")
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan and "LessThanOrEqual(p_size,45)" in plan


def test_summary_shuffles_once(spark):
    plan = queries()["gold_profit_summary"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")


def test_heavy_keys_are_looked_for_in_base_tables(spark, conf, capsys):
    """Without broadcast, no count of keys repeats a join."""
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    queries()["quarantine"](spark, SF_DIR).explain("formatted")
    _, subqueries = capsys.readouterr().out.split("===== Subqueries =====")
    counts = [text for text in re.split(r"Subquery:\d+", subqueries) if "collect_list" in text]
    assert len(counts) >= 3
    assert not any("Join" in text for text in counts)
