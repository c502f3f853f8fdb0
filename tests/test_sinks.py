import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltstone.sinks import tables
from siltstone.sinks.ddl import TableSpec, create_all, create_view, table_ddl, view_columns
from siltstone.sinks.staging import list_folder, shared_folder, stage, staged
from siltstone.sinks.tables import table_info, upsert_table, write_parquet, write_table


@pytest.fixture
def new_table(spark):
    made = []

    def create(columns="k string, v int", partitioned="", properties=""):
        name = f"t_{uuid.uuid4().hex}"
        partition = f"PARTITIONED BY ({partitioned})" if partitioned else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partition} {properties}")
        made.append(name)
        return name

    yield create
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _rows(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def test_append_binds_by_name_and_counts(spark, new_table):
    table = new_table()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    assert write_table(df, table, "append") == 2
    assert write_table(df, table, "append") == 2
    assert _rows(spark, table) == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]


def test_overwrite_from_the_table_itself(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), table)
    assert write_table(spark.table(table).where("v > 1"), table) == 1
    assert _rows(spark, table) == [("b", 2)]


def test_empty_overwrite(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1)], "k string, v int"), table)
    assert write_table(spark.table(table).where("false"), table) == 0
    assert _rows(spark, table) == []


def test_failed_overwrite_leaves_the_old_rows(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1)], "k string, v int"), table)
    broken = spark.table(table).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        write_table(broken, table)
    assert _rows(spark, table) == [("a", 1)]


def test_running_reader_keeps_its_rows(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1)], "k string, v int"), table)
    reader = spark.table(table)
    write_table(spark.createDataFrame([("b", 2)], "k string, v int"), table)
    assert reader.collect() == [("a", 1)]
    assert _rows(spark, table) == [("b", 2)]


def test_mode_and_target_guards(spark, new_table):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match=r"Unsupported mode 'merge'. Supported modes: \['append', 'overwrite'\]"):
        write_table(df, "whatever", "merge")
    for write in (lambda: write_table(df, "no_such_table"), lambda: upsert_table(df, "no_such_table", ["k"])):
        with pytest.raises(ValueError, match="Target table does not exist: no_such_table"):
            write()
    with pytest.raises(AttributeError):
        write_table(None, "main.analytics.t")
    with pytest.raises(AttributeError):
        write_parquet(None, "/output/path")


@pytest.mark.parametrize("columns", ["k string", "k string, v int, w int"])
@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_column_mismatch_is_an_error(spark, new_table, columns, mode):
    table = new_table()
    with pytest.raises(ValueError, match="Columns do not match"):
        write_table(spark.createDataFrame([], columns), table, mode)


def test_type_clash_is_an_error(spark, new_table):
    with pytest.raises(Exception, match="(?i)cannot|incompatible|invalid"):
        write_table(spark.createDataFrame([("a", "x")], "k string, v string"), new_table())


def test_append_can_evolve_the_table(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1)], "k string, v int"), table, "append")
    write_table(spark.createDataFrame([("b", 2.5)], "k string, w double"), table, "append", evolve=True)
    assert _rows(spark, table) == [("a", 1, None), ("b", None, 2.5)]


def test_write_parquet_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_parquet(df, path)
    write_parquet(df, path, "append")
    write_parquet(df, path, "ignore")
    assert spark.read.parquet(path).count() == 2
    write_parquet(df, path, partition_by=["k"])
    assert spark.read.parquet(path).select("k", "v").collect() == [("a", 1)]


# --- upsert -------------------------------------------------------------------

UPSERT_COLUMNS = "k string, part string, v int"


@pytest.mark.parametrize("partitioned", ["", "part"])
def test_upsert(spark, new_table, partitioned):
    table = new_table("k string, v int, part string", partitioned)
    target = [("a", "p1", 1), ("b", "p1", 1), ("c", "p2", 1), (None, "p3", 1), ("d", None, 1)]
    write_table(spark.createDataFrame(target, UPSERT_COLUMNS), table)
    # a stays in its partition, c moves, the NULL key is replaced, e comes in, d leaves a NULL partition
    source = [("a", "p1", 2), ("a", "p1", 1), ("c", "p1", 2), (None, "p3", 2), ("e", "p4", 2), ("d", "p1", 2)]
    df = spark.createDataFrame(source, UPSERT_COLUMNS)
    for _ in range(2):
        upsert_table(df, table, [" k "], "v")
        found = {(r.k, r.part, r.v) for r in spark.table(table).collect()}
        assert found == {
            ("a", "p1", 2), ("b", "p1", 1), ("c", "p1", 2), (None, "p3", 2), ("e", "p4", 2), ("d", "p1", 2),
        }
        assert spark.table(table).count() == 6


def _files(spark, table):
    return {r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect()}


def test_upsert_leaves_other_partitions_alone(spark, new_table):
    table = new_table("k string, v int, part string", "part")
    rows = [("a", "p1", 1), ("b", "p2", 1), ("c", "p3", 1)]
    write_table(spark.createDataFrame(rows, UPSERT_COLUMNS), table)
    before = _files(spark, table)
    upsert_table(spark.createDataFrame([("b", "p2", 5)], UPSERT_COLUMNS), table, ["k", "part"], "v")
    after = _files(spark, table)
    assert {f for f in before if "part=p2" not in f} == {f for f in after if "part=p2" not in f}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_upsert_with_quotes_in_partition_values(spark, new_table):
    table = new_table("k string, v int, part string", "part")
    write_table(spark.createDataFrame([("a", "it's \\ here", 1)], UPSERT_COLUMNS), table)
    upsert_table(spark.createDataFrame([("a", "p", 2)], UPSERT_COLUMNS), table, ["k"], "v")
    assert _rows(spark, table) == [("a", 2, "p")]


def test_upsert_tombstones_with_a_flag_column(spark, new_table):
    table = new_table()
    write_table(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), table)
    source = spark.createDataFrame([("a", 2, "delete"), ("b", 2, "update")], "k string, v int, op string")
    upsert_table(source, table, ["k"], "v", delete_when="op = 'delete'")
    assert _rows(spark, table) == [("b", 2)]
    with pytest.raises(ValueError, match="Columns do not match"):
        upsert_table(source, table, ["k"], "v")


def test_empty_upsert(spark, new_table):
    for partitioned in ("", "part"):
        table = new_table("k string, v int, part string", partitioned)
        write_table(spark.createDataFrame([("a", "p1", 1)], UPSERT_COLUMNS), table)
        upsert_table(spark.createDataFrame([], UPSERT_COLUMNS), table, ["k"], "v")
        assert spark.table(table).count() == 1


def test_overwrite_partitioned_table_drops_absent_partitions(spark, new_table):
    table = new_table("k string, v int, part string", "part")
    write_table(spark.createDataFrame([("a", "p1", 1), ("b", "p2", 1)], UPSERT_COLUMNS), table)
    write_table(spark.table(table).where("part = 'p2'"), table)
    assert _rows(spark, table) == [("b", 1, "p2")]
    assert write_table(spark.table(table).where("false"), table) == 0
    assert _rows(spark, table) == []
    assert spark.sql(f"SHOW PARTITIONS {table}").isEmpty()


@pytest.mark.parametrize("newer, flag", [(None, None), ("v", None), ("v", "__delete")])
def test_merge_statement_is_valid_sql(spark, new_table, newer, flag):
    statement = tables.merge_statement(new_table(), ["k", "v"], newer, flag)
    source = spark.createDataFrame([("a", 1, False)], "k string, v int, __delete boolean")
    # Parquet tables cannot merge, which Spark says only after it understood the statement
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        spark.sql(statement, source=source)


# --- layout and DDL -------------------------------------------------------------


def test_clustered_table_has_narrow_files(spark, new_table):
    table = new_table("k int, v int", properties="TBLPROPERTIES ('siltstone.cluster_by' = 'k')")
    assert table_info(spark, table).cluster_by == ["k"]
    df = spark.range(8000, numPartitions=8).selectExpr("CAST(id % 1000 AS INT) AS k", "CAST(id AS INT) AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_table(df, table)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    spans = (
        spark.table(table).groupBy("_metadata.file_path").agg((F.max("k") - F.min("k")).alias("span")).collect()
    )
    assert len(spans) > 1 and max(r.span for r in spans) < 300


def test_one_cluster_value_is_cut_between_files(spark, conf):
    conf(**{"spark.sql.adaptive.enabled": "false"})
    df = spark.range(8000).selectExpr("1 AS k", "id AS v")
    parts = tables.clustered(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8


def test_ddl(spark):
    database = f"db_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], "k string, load_timestamp timestamp, load_type string").schema
    spec = TableSpec("t", schema, cluster_by=["k"], view="vw_t")
    for _ in range(2):
        create_all(spark, database, [spec])
    assert view_columns(schema) == ["k"]
    assert spark.table(f"{database}.vw_t").columns == ["k"]
    assert spark.table(f"{database}.t").schema == schema
    create_view(spark, database, spec)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_clustering_clause_is_for_delta(spark):
    schema = spark.createDataFrame([], "k string, d date").schema
    spec = TableSpec("t", schema, cluster_by=["k", "d"])
    assert "CLUSTER BY (k, d)" in table_ddl("db", spec, "delta")
    assert "CLUSTER BY" not in table_ddl("db", spec)
    assert "'siltstone.cluster_by' = 'k,d'" in table_ddl("db", spec)
    assert "PARTITIONED BY (d)" in table_ddl("db", replace(spec, partition_by=["d"]), "delta")


def test_emptied_partition_of_an_external_table_stays_empty(spark, tmp_path):
    spark.sql(
        f"CREATE TABLE outside (k string, v int, part string) USING parquet PARTITIONED BY (part) "
        f"LOCATION '{tmp_path / 'outside'}'"
    )
    write_table(spark.createDataFrame([("a", "p1", 1), ("b", "p2", 1)], UPSERT_COLUMNS), "outside")
    upsert_table(spark.createDataFrame([("a", "p2", 2)], UPSERT_COLUMNS), "outside", ["k"], "v")
    write_table(spark.createDataFrame([("c", "p1", 3)], UPSERT_COLUMNS), "outside", "append")
    found = _rows(spark, "outside")
    spark.sql("DROP TABLE outside")
    assert found == [("a", 2, "p2"), ("b", 1, "p2"), ("c", 3, "p1")]


def test_upsert_over_many_partitions(spark, new_table):
    table = new_table("k string, v int, part string", "part")
    rows = spark.range(300).selectExpr("CAST(id AS STRING) AS k", "CAST(id % 150 AS STRING) AS part", "1 AS v")
    write_table(rows, table)
    upsert_table(rows.withColumn("v", F.lit(2)), table, ["k"], "v")
    assert spark.table(table).agg(F.sum("v"), F.count("*")).first() == (600, 300)


def test_view_follows_a_replaced_table(spark):
    database = f"db_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], "k string, load_type string").schema
    create_all(spark, database, [TableSpec("t", schema, view="vw_t")])
    for value in ("a", "b"):
        write_table(spark.createDataFrame([(value, "FULL")], schema), f"{database}.t")
        assert spark.table(f"{database}.vw_t").collect() == [(value,)]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_stage_uses_the_cluster_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    staged = stage(spark.createDataFrame([("a", None), ("b", "x")], "k string, r string"), "rows", ["r"])
    assert staged.columns == ["k", "r"]
    assert sorted(staged.collect()) == [("a", None), ("b", "x")]
    assert folder in staged.inputFiles()[0]


def test_staged_rows_are_removed_afterwards(spark):
    with staged(spark.createDataFrame([("a",)], "k string"), "rows") as rows:
        file = rows.inputFiles()[0]
        assert rows.collect() == [("a",)] and list_folder(spark, file.rpartition("/")[0])
    assert list_folder(spark, file.rpartition("/")[0]) == []


def test_superseded_contents_can_be_removed(spark, new_table):
    table = new_table()
    assert tables.remove_superseded(spark, table) == 0
    for n in range(3):
        write_table(spark.createDataFrame([("a", n)], "k string, v int"), table)
    assert tables.remove_superseded(spark, table) == 2
    assert tables.remove_superseded(spark, table) == 0
    assert _rows(spark, table) == [("a", 2)]


class _Session:
    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_shared_folder_is_never_local_on_a_cluster():
    for warehouse in ("file:/home/driver/warehouse", None):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(_Session(spark_master="spark://host:7077", spark_sql_warehouse_dir=warehouse))
    alone = _Session(spark_master="local[2]", spark_sql_warehouse_dir="file:/home/warehouse/")
    assert shared_folder(alone) == "file:/home/warehouse/_staged"
    named = _Session(spark_master="yarn", spark_sql_warehouse_dir="s3a://b/warehouse")
    assert shared_folder(named) == "s3a://b/warehouse/_staged"
    assert shared_folder(_Session(spark_checkpoint_dir="s3a://b/x/")) == "s3a://b/x"
