import re
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from siltstone.operators.merge import CHANGE, merge_rows
from siltstone.retail import jobs, schemas
from siltstone.retail.jobs import RetailConfig
from siltstone.sinks.ddl import TableSpec, table_ddl
from siltstone.sinks.tables import table_info, upsert_table, upsert_with_changes, write_table

COLUMNS = "k int, part string, v int, seq int"


@pytest.fixture
def table(spark):
    made = []

    def create(keys="k", more=""):
        name = f"b_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet {more} CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO 5 BUCKETS")
        made.append(name)
        return name

    yield create
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _files(spark, name):
    """Files by bucket, as their names tell."""
    found = {}
    for path in spark.table(name).inputFiles():
        bucket = int(re.search(r"_(\d{5})\.", path).group(1))
        found[bucket] = found.get(bucket, 0) + 1
    return found


OLD = [(n, "a", n, 5) for n in range(200)] + [(None, "a", -1, 5)]
NEW = [(n, "b", n * 2, n % 10) for n in range(150, 260)] + [(7, "c", 1, 4), (7, "d", 2, 6)]


@pytest.mark.parametrize("keys", [["k"], ["part", "k"]])
@pytest.mark.parametrize("null_key", [False, True])
@pytest.mark.parametrize("options", [{}, {"only_if_newer": True}, {"delete_when": "v % 3 = 0"}])
def test_upsert_in_buckets_equals_the_general_merge(spark, table, keys, null_key, options):
    name = table(",".join(reversed(keys)))
    write_table(_frame(spark, OLD), name)
    batch = _frame(spark, NEW + ([(None, "a", 9, 9)] if null_key else []))
    options_of_rows = options | ({"delete_when": F.expr(options["delete_when"])} if "delete_when" in options else {})
    expected = _rows(merge_rows(_frame(spark, OLD), batch, keys, "seq", ["v"], **options_of_rows))
    for _ in range(2):
        upsert_table(batch, name, keys, "seq", ["v"], **options)
        assert _rows(spark.table(name)) == expected
    assert set(_files(spark, name)) <= set(range(5))
    # buckets are what Spark takes them for: a filter on the keys reads one of them
    assert spark.table(name).where("k = 7 AND part >= ''").count() == spark.table(name).where("k + 0 = 7").count()


def test_files_of_a_bucket_stay_few(spark, table):
    name = table()
    write_table(_frame(spark, OLD), name)
    for n in range(4):
        upsert_table(_frame(spark, [(k, "x", k, 10 + n) for k in range(n, 300, 7)]), name, ["k"], "seq")
    assert max(_files(spark, name).values()) <= 2
    assert write_table(_frame(spark, [(500, "y", 1, 1)]), name, "append") == 1
    assert spark.table(name).where("k = 500").count() == 1


def test_the_target_is_not_shuffled(spark, table, conf):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    name = table()
    write_table(_frame(spark, OLD), name)
    batch = _frame(spark, [(n, "b", n, 9) for n in range(100)])
    for newer in (False, True):
        merged = merge_rows(spark.table(name), batch.repartition(5, "k"), ["k"], "seq", only_if_newer=newer, in_buckets=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        # what is below an exchange is the batch
        lines = plan.split("\n")
        for n, line in enumerate(lines):
            if "Exchange" not in line:
                continue
            depth = re.search(r"[A-Z]", line).start()
            for below in lines[n + 1 :]:
                start = re.search(r"[A-Za-z*]", below)
                if start is None or start.start() <= depth:
                    break
                assert "FileScan" not in below
    general = merge_rows(spark.table(name), batch, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" not in general


def test_change_set_of_buckets(spark, table):
    name = table()
    write_table(_frame(spark, OLD), name)
    batch = _frame(spark, [(1, "b", 5000, 9), (900, "b", 5001, 9)])
    with upsert_with_changes(batch, name, ["k"], "seq") as (rows, changes):
        assert rows == len(OLD) + 1
        assert sorted((r.k, r[CHANGE]) for r in changes.collect()) == [(1, -1), (1, 1), (900, 1)]
    assert spark.table(name).where("v IN (5000, 5001)").count() == 2 and spark.table(name).where("k IS NULL").count() == 1


def test_a_failed_upsert_leaves_the_table_and_no_other(spark, table):
    name = table()
    write_table(_frame(spark, OLD), name)
    before = {t.name for t in spark.catalog.listTables()}
    broken = _frame(spark, [(1, "b", 1, 9)]).withColumn("part", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        upsert_table(broken, name, ["k"], "seq")
    assert _rows(spark.table(name)) == _rows(_frame(spark, OLD))
    assert {t.name for t in spark.catalog.listTables()} == before


def test_buckets_and_partitions_exclude_each_other(spark, table):
    spec = TableSpec("t", schemas.silver_customer.schema, partition_by=["country"], bucket_by=["customer_id"], buckets=4)
    with pytest.raises(ValueError, match="cannot have buckets"):
        table_ddl("db", spec)
    name = table(more="PARTITIONED BY (part)")
    with pytest.raises(ValueError, match="partitions and buckets"):
        write_table(_frame(spark, [(1, "a", 1, 1)]), name)


def test_jobs_curate_into_buckets(spark):
    run_at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    config = RetailConfig(database=f"db_{uuid.uuid4().hex}", buckets={"silver_customer": 3, "silver_order": 4})
    with pytest.raises(ValueError, match="No curated table"):
        jobs.setup(spark, RetailConfig(database=config.database, buckets={"bronze_order": 3}))
    jobs.setup(spark, config)
    try:
        info = table_info(spark, f"{config.database}.silver_order")
        assert (info.buckets, info.bucket_by) == (4, list(config.order_keys))
        for day, name in enumerate(("Ann", "Anne")):
            customers = spark.createDataFrame([("c1", name), (f"c{day + 2}", "Bob")], "customer_id string, customer_name string")
            typed = schemas.bronze_customer.schema
            rows = customers.select(
                *((F.col(f.name) if f.name in customers.columns else F.lit("x")).cast(f.dataType).alias(f.name) for f in typed)
            ).drop("load_timestamp", "load_type", schemas.BATCH_COLUMN)
            at = run_at + timedelta(days=day)
            jobs.store_batch(spark, config, [jobs.customer_feed(rows)], at)
            jobs.curate_customers(spark, config, at)
        held = spark.table(f"{config.database}.silver_customer").select("customer_id", "customer_name")
        assert _rows(held) == [("c1", "Anne"), ("c2", "Bob"), ("c3", "Bob")]
    finally:
        spark.sql(f"DROP SCHEMA {config.database} CASCADE")
