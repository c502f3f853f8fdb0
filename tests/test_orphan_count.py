"""Unknown keys counted without shuffling facts, where dimensions may not be broadcast."""

import pytest
from pyspark.sql import functions as F

from siltstone.operators.enrich import DimensionLink, orphan_count

OFF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _links(spark):
    customers = spark.createDataFrame([("c1",), ("c2",), ("c2",), (None,)], "customer string")
    products = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    return [DimensionLink(customers, "customer"), DimensionLink(products, "product", ["name"], "id")]


def _counts(df):
    return {r.check_name: r.orphans for r in df.collect()}


@pytest.mark.parametrize("off", [False, True])
def test_counts_equal_a_loop_over_the_rows(spark, conf, off):
    if off:
        conf(**OFF)
    customers, products = ["c1", "c1", "c2", "c9", None], [1, 2, 3, None]
    rows = [(customers[n % 5], products[n % 4], n) for n in range(997)] + [("c7", 1, 1)] * 500
    facts = spark.createDataFrame(rows, "customer string, product long, n int")
    assert _counts(orphan_count(facts, _links(spark))) == {
        "customer": sum(c not in ("c1", "c2") for c, _, _ in rows),
        "product": sum(p not in (1, 2) for _, p, _ in rows),
    }


def test_no_facts_and_empty_dimensions(spark, conf):
    conf(**OFF)
    links = _links(spark)
    none = spark.createDataFrame([], "customer string, product long")
    assert _counts(orphan_count(none, links)) == {"customer": 0, "product": 0}
    nothing_known = [DimensionLink(links[0].dim.where("false"), "customer")]
    assert _counts(orphan_count(spark.createDataFrame([("c1",), (None,)], "customer string"), nothing_known)) == {"customer": 2}


def test_only_counted_keys_are_shuffled(spark, conf):
    conf(**OFF, **{"spark.sql.adaptive.enabled": "false"})
    facts = spark.range(0, 100_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("customer"), (F.col("id") % 5).alias("product")
    )
    found = orphan_count(facts, _links(spark))
    assert _counts(found) == {
        "customer": sum(n % 3 == 0 or n % 7 not in (1, 2) for n in range(100_000)),
        "product": sum(n % 5 not in (1, 2) for n in range(100_000)),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 100000") == 1
    above_facts = plan[: plan.index("Range (0, 100000")].split("\n")
    first = next(line for line in reversed(above_facts) if "Exchange" in line or "HashAggregate" in line)
    assert "partial_count" in first
