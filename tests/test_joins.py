"""Star joins on the broadcast path and on the salted path, against plain joins."""

import pytest
from pyspark.sql import functions as F

from siltstone.operators import joins
from siltstone.operators.enrich import (
    DimensionLink, accepted, classify, enrich_star, orphan_count, rejected, split_orphans,
)

HOWS = ["left", "inner", "left_semi", "left_anti"]


@pytest.fixture
def skewed(spark):
    """9,000 rows: a third on one key, a third without a key, the rest spread out."""
    rows = spark.range(0, 9000, numPartitions=12)
    key = (
        F.when(F.col("id") < 3000, F.lit(7))
        .when(F.col("id") < 6000, F.lit(None))
        .otherwise(F.col("id") - 6000)
        .cast("int")
    )
    # rows of one key lie in every input split
    return rows.repartition(12, F.xxhash64("id")).select(key.alias("k"), "id")


@pytest.fixture
def dim(spark):
    return spark.range(0, 2500).select(
        F.col("id").alias("dim_key"), F.concat(F.lit("name "), "id").alias("name")
    )


def _plain(fact, dim, how):
    joined = fact.join(dim, fact.k == dim.dim_key, how)
    return joined.select("k", "id", "name") if how in ("left", "inner") else joined


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("limit", ["10mb", "-1"])
def test_same_rows_as_plain_join(skewed, dim, conf, how, limit):
    expected = sorted(map(tuple, _plain(skewed, dim, how).collect()), key=str)
    conf(**{"spark.sql.autoBroadcastJoinThreshold": limit})
    found = joins.join_dimension(skewed, dim, {"k": "dim_key"}, how)
    assert sorted(map(tuple, found.collect()), key=str) == expected


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("limit", ["10mb", "-1"])
def test_null_safe_join(skewed, dim, conf, how, limit):
    dim = dim.unionAll(dim.limit(1).select(F.lit(None).cast("bigint"), F.lit("nobody")))
    joined = skewed.join(dim, skewed.k.eqNullSafe(dim.dim_key), how)
    expected = joined.select("k", "id", "name") if how in ("left", "inner") else joined
    expected = sorted(map(tuple, expected.collect()), key=str)
    conf(**{"spark.sql.autoBroadcastJoinThreshold": limit})
    found = joins.join_dimension(skewed, dim, {"k": "dim_key"}, how, null_safe=True)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def _largest_share(joined):
    per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    return per_task / joined.count()


def test_hot_and_missing_keys_are_spread_over_tasks(skewed, dim, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    plain = skewed.join(dim, skewed.k == dim.dim_key, "left")
    salted = joins.join_dimension(skewed, dim, {"k": "dim_key"})
    assert _largest_share(plain) > 0.33
    assert _largest_share(salted) < 0.25


def test_hot_keys_lists_heavy_keys_only(skewed):
    hot = skewed.select(joins.hot_key_hashes(skewed, ["k"], 8).alias("hot")).first().hot
    heavy = skewed.select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    missing = skewed.select(F.xxhash64(F.lit(None).cast("long"))).first()[0]
    assert sorted(hot) == sorted([heavy, missing])


def test_all_keys_above_an_average_partition_are_hot(spark):
    """150 keys with 40 rows each among 400 partitions of 20 rows on average."""
    heavy = spark.range(0, 6000).select((F.col("id") % 150).alias("k"))
    light = spark.range(1000, 3000).select(F.col("id").alias("k"))
    rows = heavy.unionAll(light).repartition(7)
    hot = rows.select(joins.hot_key_hashes(rows, ["k"], 400).alias("hot")).first().hot
    expected = [r[0] for r in spark.range(0, 150).select(F.xxhash64("id")).collect()]
    assert sorted(hot) == sorted(expected)


def test_composite_key_of_different_width(spark, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    fact = spark.range(4000, numPartitions=4).selectExpr(
        "CAST(1 AS INT) AS a", "CAST(2 AS SMALLINT) AS b", "id"
    )
    dim = spark.createDataFrame([(1, 2, "x"), (1, 3, "y")], "p bigint, q bigint, name string")
    joined = joins.join_dimension(fact, dim, {"a": "p", "b": "q"})
    assert joined.where("name = 'x'").count() == 4000


@pytest.mark.parametrize("limit", ["10mb", "-1"])
def test_keys_of_different_kind_compare_as_spark_casts_them(spark, dim, conf, limit):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": limit})
    fact = spark.createDataFrame([("01",)] * 500 + [("9999",)], "k string")
    assert joins.join_dimension(fact, dim, {"k": "dim_key"}, "inner").count() == 500
    assert joins.orphans(fact, dim, "k", "dim_key").count() == 1


def test_wider_dimension_keys_do_not_overflow(spark, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    fact = spark.range(100).selectExpr("CAST(5 AS INT) AS k", "id")
    dim = spark.createDataFrame([(5, "x"), (2**40, "y")], "dim_key bigint, name string")
    assert joins.join_dimension(fact, dim, {"k": "dim_key"}, "inner").count() == 100


def test_small_joined_dimension_is_broadcast(spark, dim):
    other = spark.range(2500).select(F.col("id").alias("other_key"), F.lit("x").alias("extra"))
    wide = dim.join(other, dim.dim_key == other.other_key).drop("other_key")
    assert joins.fits_broadcast([wide]) == [True]


def test_small_files_may_hold_too_much(spark, tmp_path):
    path = str(tmp_path / "equal")
    spark.range(800_000).selectExpr("1 AS k", "repeat('x', 100) AS v").coalesce(1).write.parquet(path)
    equal = spark.read.parquet(path)
    assert joins._input_bytes(equal) < 1_000_000
    assert joins.fits_broadcast([equal, equal.limit(3)]) == [False, True]


def test_large_inputs_are_not_measured(spark, dim, conf, monkeypatch):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "100b"})
    monkeypatch.setattr(joins, "measured_bytes", lambda frames: pytest.fail("measured"))
    assert joins.fits_broadcast([dim]) == [False]


def test_large_dimension_is_not_broadcast(dim, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "1kb"})
    assert joins.broadcast_limit(dim) == 8 * 1024
    assert joins.fits_broadcast([dim]) == [False]


def test_nested_columns_have_no_measured_size(spark):
    nested = spark.range(3).select(F.array("id").alias("ids"))
    assert joins.fits_broadcast([nested, spark.range(3)]) == [False, True]


def test_frames_are_measured_together(spark):
    texts = spark.createDataFrame([("abc",), (None,)], "s string")
    assert joins.measured_bytes([texts, texts.where("false"), spark.range(2)]) == [2 * 32 + 3, 0, 2 * 32]


@pytest.mark.parametrize("how", HOWS)
def test_empty_sides_of_a_salted_join(skewed, dim, conf, how):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    nothing = skewed.where("false")
    assert joins.join_dimension(nothing, dim, {"k": "dim_key"}, how).count() == 0
    unmatched = joins.join_dimension(skewed, dim.where("false"), {"k": "dim_key"}, how)
    assert unmatched.count() == (9000 if how in ("left", "left_anti") else 0)


def test_attribute_clash_is_an_error(skewed, dim):
    with pytest.raises(ValueError, match="both sides"):
        joins.join_dimension(skewed, dim.withColumn("id", F.lit(1)), {"k": "dim_key"})


def test_repeated_dimension_keys_do_not_multiply_known_rows(skewed, dim):
    twice = dim.unionAll(dim)
    assert joins.known_rows(skewed, twice, "k", "dim_key").count() == 5500


# --- split and enrichment ---------------------------------------------------


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame(
        [("o1", "c1", "p1", 1.005), ("o2", "c9", "p9", 2.0), ("o3", "c1", "p9", 3.0), ("o4", None, "p1", 4.0)],
        "order_id string, customer_id string, product_id string, profit double",
    )
    customers = spark.createDataFrame([("c1", "Ann")], "customer_id string, customer_name string")
    products = spark.createDataFrame([("p1", "Toys")], "product_id string, category string")
    links = [
        DimensionLink(customers, "customer_id", ["customer_name"]),
        DimensionLink(products, "product_id", ["category"]),
    ]
    return fact, links


def test_first_unknown_key_gives_the_reason(star):
    fact, links = star
    reasons = {r.order_id: r.reject_reason for r in classify(fact, links).collect()}
    assert reasons == {
        "o1": None, "o2": "unknown customer_id", "o3": "unknown product_id", "o4": "unknown customer_id",
    }


def test_split_keeps_every_row_once(star):
    fact, links = star
    good, bad = split_orphans(fact, links)
    assert good.columns == fact.columns
    assert bad.columns == [*fact.columns, "reject_reason"]
    both = sorted(map(tuple, good.unionAll(bad.drop("reject_reason")).collect()), key=str)
    assert both == sorted(map(tuple, fact.collect()), key=str)


def test_classified_rows_are_enriched_and_rounded(star):
    fact, links = star
    classified = classify(fact, links, ["profit"])
    assert accepted(classified).collect() == [("o1", "c1", "p1", 1.01, "Ann", "Toys")]
    assert rejected(classified, fact.columns).count() == 3


def test_inner_enrichment_keeps_accepted_rows(star):
    fact, links = star
    inner = enrich_star(fact, links, ["profit"], how="inner")
    assert inner.collect() == accepted(classify(fact, links, ["profit"])).collect()


def test_orphans_are_counted_per_key(star):
    fact, links = star
    repeated = [DimensionLink(l.dim.unionAll(l.dim), l.fact_key) for l in links]
    counts = orphan_count(fact, repeated).collect()
    assert sorted(counts) == [("customer_id", 2), ("product_id", 2)]


def test_every_fact_is_an_orphan_of_an_empty_dimension(star):
    fact, links = star
    nobody = links[0].dim.where("false")
    assert joins.orphans(fact, nobody, "customer_id").count() == 4
