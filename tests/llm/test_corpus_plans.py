"""What Spark makes of the corpus queries: no quadratic joins, and no Python in the native ones."""

import pytest

from siltstone.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op3_", "op4_")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_no_quadratic_joins_and_native_ones_without_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name.startswith(NATIVE):
        assert "Python" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan
