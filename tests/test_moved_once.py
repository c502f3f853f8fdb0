"""Rows are joined, written and shuffled no more often than the result needs."""

from contextlib import ExitStack
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.keys import latest_of_repeated, latest_per_key, repeated_hashes
from siltstone.operators.merge import without_matches
from siltstone.plans import model_views as views
from siltstone.plans.queries import QUERIES
from siltstone.retail.jobs import _rows_of_keys
from siltstone.sinks import tables
from siltstone.sinks.ddl import TableSpec, create_table
from siltstone.sources.rejects import scan_json

DAY = datetime(2001, 5, 1)
ROWS = {
    "nation": [(0, "PERU", 0)],
    "customer": [(1, "Ann", 0, 5.0, "M"), (2, "Bob", 0, 5.0, "M")],
    "part": [(1, "nut", "B1", "T1", 1, 2.0)],
    "orders": [(1, 1, "O", 9.0, DAY, "1"), (2, 2, "O", 9.0, datetime(1999, 5, 1), "1")],
    "lineitem": [
        (1, 1, 1, 1, 1.0, 100.0, 0.0, 0.0, "N", "O", DAY),
        (2, 1, 1, 1, 1.0, 200.0, 0.0, 0.0, "N", "O", datetime(1999, 6, 1)),
    ],
}


@pytest.fixture
def star(spark, tmp_path):
    for name, rows in ROWS.items():
        schema = T.StructType([T.StructField(c, t) for c, t in views.TABLES[name].items()])
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA moved LOCATION '{tmp_path}/moved'")
    yield "moved"
    spark.sql("DROP SCHEMA moved CASCADE")


def test_incremental_gold_joins_the_lines_once(spark, star):
    found = QUERIES["incremental_gold"](spark, star)
    assert "lineitem.parquet" not in found._jdf.queryExecution().toString()
    assert sorted((r.year, r.customer_name, r.total_profit) for r in found.collect()) == [(1999, "Bob", 12.0), (2001, "Ann", 6.0)]


def test_text_of_good_records_is_not_written(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text('{"a": 1}\n{"a": "x"}\n')
    scan = scan_json(spark, str(path), T.StructType([T.StructField("a", T.IntegerType())]))
    kept = scan.of(scan.without_good_text)
    assert [r.a for r in kept.good.collect()] == [1]
    assert [tuple(r) for r in kept.rejects.collect()] == [('{"a": "x"}', "bad a")]
    assert kept.judged.where("__record IS NOT NULL").count() == 1


def test_prepared_rows_are_not_written_again(spark, database):
    create_table(spark, database, TableSpec("raw", T._parse_datatype_string("a int, b string"), partition_by=["b"]))
    rows = spark.createDataFrame([(1, "x"), (2, "x")], "a int, b string")
    for total in (2, 4):  # the second time the partition is held already
        with tables.prepared_append(rows, "moved.raw") as prepared:
            assert spark.table("moved.raw").count() == total - 2
            assert tables.write_table(prepared, "moved.raw", mode="append") == 2
        assert spark.table("moved.raw").count() == total
    with tables.prepared_append(rows.withColumn("b", F.lit("y")), "moved.raw"):
        pass
    assert spark.table("moved.raw").where("b = 'y'").isEmpty()


ODD = [(None, 1, 0.0), (None, 1, -0.0), (None, 2, float("nan")), (3, None, float("nan")), (3, None, float("nan")), (4, 4, 1.0)]


def test_only_rows_of_repeated_keys_are_ranked(spark):
    df = spark.createDataFrame([(*row, n) for n, row in enumerate(ODD)], "a int, b int, c double, load_timestamp int")
    keys = ["a", "b", "c"]
    repeated = repeated_hashes(df, keys)
    assert repeated.count() == 2
    found = latest_of_repeated(df, repeated, keys)
    assert sorted(r.load_timestamp for r in found.collect()) == [1, 2, 4, 5]
    assert sorted(map(str, found.collect())) == sorted(map(str, latest_per_key(df, keys).collect()))


def test_upsert_of_unique_keys_into_an_empty_table_shuffles_for_the_layout_alone(spark, database, monkeypatch):
    spec = TableSpec("curated", T._parse_datatype_string("a int, b int, load_timestamp int"), cluster_by=["a", "b"])
    create_table(spark, database, spec)
    df = spark.createDataFrame([(1, 1, 1), (2, None, 1)], spec.schema)
    seen = []
    laid = tables.clustered
    monkeypatch.setattr(tables, "clustered", lambda rows, by, like=None, within=(): seen.append((rows, like)) or laid(rows, by, like, within))
    assert tables.upsert_table(df, "moved.curated", ["a", "b"]) == 2
    rows, like = seen[0]
    assert like is df
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    again = spark.createDataFrame([(2, None, 2), (2, None, 3), (5, 5, 2)], spec.schema)
    assert tables.upsert_table(again, "moved.curated", ["a", "b"]) == 3
    assert sorted(map(tuple, spark.table("moved.curated").collect())) == [(1, 1, 1), (2, None, 3), (5, 5, 2)]


def test_unique_keys_are_listed_without_a_shuffle_of_their_own(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    plan = without_matches(df, df.where("a > 1"), ["a"], unique=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_rows_of_keys_with_nulls_by_hash_and_by_key(spark, database, conf):
    create_table(spark, database, TableSpec("held", T._parse_datatype_string("a int, b int, n int")))
    rows = [(None, 1, 1), (1, None, 2), (2, 2, 3), (3, 3, 4)]
    tables.write_table(spark.createDataFrame(rows, "a int, b int, n int"), "moved.held")
    listed = spark.createDataFrame([(None, 1), (None, 1), (2, 2), (9, 9)], "a int, b int")
    for threshold in ("10m", "-1"):
        conf(spark__sql__autoBroadcastJoinThreshold=threshold)
        with ExitStack() as scratch:
            found = _rows_of_keys(spark, "moved.held", listed, ["a", "b"], scratch)
            assert sorted(r.n for r in found.collect()) == [1, 3]
            none = _rows_of_keys(spark, "moved.held", listed.where("a = 9"), ["a", "b"], scratch)
            assert "Join" not in none._jdf.queryExecution().optimizedPlan().toString() and none.isEmpty()
