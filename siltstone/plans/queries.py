"""The registered queries. Each reads whole tables; ``oracle.py`` holds the SQL for each."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.audit import add_audit_columns
from siltstone.functions.dates import date_parse_failures, parse_dates
from siltstone.functions.headers import sanitize_column_names
from siltstone.functions.money import round_money
from siltstone.operators import enrich, quality
from siltstone.operators.batches import latest_batch
from siltstone.operators.enrich import REJECT_REASON, classify, enrich_star, rejected
from siltstone.operators.joins import known_rows, orphans
from siltstone.operators.keys import dedupe, duplicate_keys, latest_per_key
from siltstone.operators.merge import merge_rows
from siltstone.operators.rollup import changed_groups, incremental_rollup, rollup_measure
from siltstone.operators.ordering import with_positions
from siltstone.plans import model_views as views
from siltstone.plans.batch_runs import ingest_run, quarantine_release, running_gold
from siltstone.plans.retail_run import retail_run
from siltstone.plans.workbook_samples import as_workbooks
from siltstone.retail import reports
from siltstone.retail.schemas import PROFIT_KEYS
from siltstone.sinks.ddl import TableSpec, create_table, create_view
from siltstone.sinks.staging import new_folder, stage
from siltstone.sinks.tables import upsert_table, write_parquet, write_table
from siltstone.sources.catalog import read_table
from siltstone.sources.files import read_delimited, read_json
from siltstone.sources.json_arrays import scan_json_array
from siltstone.sources.rejects import Scan, scan_delimited, scan_json
from siltstone.sources.workbooks import decode_workbooks

Query = Callable[[SparkSession, str], DataFrame]

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "batch_day"]
LINE_ID = ["order_id", "line_no", "supplier_id", "product_id"]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles."""
    wide = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in wide}) if wide else df


# --- profit summary, reports, views ----------------------------------------


def gold_profit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = reports.with_year(views.silver_lines(spark, sf_dir))
    return rollup_measure(lines, PROFIT_KEYS, "profit")


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of lines shipped up to 2000, brought up to date with the later ones."""
    later = F.col("ship_date") >= F.lit("2001-01-01").cast("date")
    # read four times: joined and written once, as narrow as the summary needs it
    lines = reports.with_year(views.silver_lines(spark, sf_dir)).select(*PROFIT_KEYS, "profit", "ship_date")
    lines = stage(lines, "lines")
    summary = rollup_measure(lines.where(~later), PROFIT_KEYS, "profit")
    # used twice, and measured: written once
    groups = stage(changed_groups(lines.where(later), PROFIT_KEYS), "groups")
    return incremental_rollup(lines, summary, groups, PROFIT_KEYS, "profit")


def _report(name: str) -> Query:
    return lambda spark, sf_dir: reports.REPORTS[name](views.silver_lines(spark, sf_dir))


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.order_lines(spark, sf_dir)
    return _plain(enrich_star(lines, views.links(spark, sf_dir), ["profit"]))


def silver_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(views.silver_lines(spark, sf_dir))


def _ordered(name: str) -> Query:
    """A report with each row's place in its order."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = reports.REPORTS[name](views.silver_lines(spark, sf_dir))
        return with_positions(report, reports.report_order(name))

    return read


def _view(rows: Query) -> Query:
    """A stored table with audit columns, read through its view."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = add_audit_columns(_plain(rows(spark, sf_dir)), "INCREMENTAL")
        spec = TableSpec("curated", stored.schema, view="vw_curated")
        database = f"views_{uuid.uuid4().hex}"
        spark.sql(f"CREATE SCHEMA {database} LOCATION '{new_folder(spark, 'database')}'")
        try:
            create_table(spark, database, spec)
            write_table(stored, f"{database}.{spec.name}", "append")
            return stage(spark.table(create_view(spark, database, spec)), "view")
        finally:
            spark.sql(f"DROP SCHEMA {database} CASCADE")

    return read


# --- batches, keys ----------------------------------------------------------


def latest_batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_batch(views.events(spark, sf_dir), "batch_day").select(*EVENT_COLUMNS)


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(views.events(spark, sf_dir), ["user_id"], "ts", ["event_id"])


def dedupe_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.all_customers(spark, sf_dir)
    restated = customers.withColumn("segment", F.lower("segment"))
    return dedupe(customers.unionByName(restated), ["customer_id"])


def dedupe_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = views.all_products(spark, sf_dir)
    dearer = products.withColumn("price_per_product", F.col("price_per_product") + 1)
    return dedupe(products.unionByName(dearer), ["product_id"])


def repeated_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS line_no"
    )
    return duplicate_keys(lines, ["order_id", "line_no"])


# --- quality ------------------------------------------------------------------


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = enrich_star(views.order_lines(spark, sf_dir), views.links(spark, sf_dir))
    return quality.null_profile(lines, ["order_id", "customer_id", "customer_name", "country", "category"])


def line_rules() -> list[quality.Rule]:
    return [
        quality.Rule("price_not_negative", "price", F.col("price") < 0, "Price cannot be negative"),
        quality.Rule("quantity_positive", "quantity", F.col("quantity") <= 0, "Quantity must be greater than zero"),
        quality.Rule("no_loss", "profit", F.col("profit") < 0, "Line sold at a loss"),
        quality.Rule("discount_within_margin", "discount", F.col("discount") > 0.08, "Discount too high"),
    ]


def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_summary(views.order_lines(spark, sf_dir), line_rules())


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = quality.rule_violations(views.order_lines(spark, sf_dir), line_rules())
    return broken.select(*LINE_ID, "rule")


def quality_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"no_loss": 1_000_000_000, "discount_within_margin": 10}
    return quality.against_limits(rule_summary(spark, sf_dir), "rule", "violations", limits)


def orphans_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, (link, _) = views.order_lines(spark, sf_dir), views.links(spark, sf_dir)
    return _plain(orphans(lines, link.dim, link.fact_key, key_rows=link.key_rows))


def orphans_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, (_, link) = views.order_lines(spark, sf_dir), views.links(spark, sf_dir)
    return _plain(orphans(lines, link.dim, link.fact_key, key_rows=link.key_rows))


def orphan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.orphan_count(views.order_lines(spark, sf_dir), views.links(spark, sf_dir))


def known_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.order_lines(spark, sf_dir)
    for link in views.links(spark, sf_dir):
        lines = known_rows(lines, link.dim, link.fact_key, key_rows=link.key_rows)
    return _plain(lines)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.order_lines(spark, sf_dir)
    return _plain(rejected(classify(lines, views.links(spark, sf_dir)), lines.columns))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, accepted and rejected by reason, from one pass over the lines."""
    lines = classify(views.order_lines(spark, sf_dir), views.links(spark, sf_dir))
    reason = F.col(REJECT_REASON)
    counts = lines.agg(
        F.count("*").alias("lines"),
        F.count_if(reason.isNull()).alias("accepted"),
        F.count_if(reason == "unknown customer_id").alias("unknown customer_id"),
        F.count_if(reason == "unknown product_id").alias("unknown product_id"),
    )
    return counts.unpivot([], counts.columns, "stage", "rows")


def cleansed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "balance": F.greatest("balance", F.lit(0.0)),
        "segment": F.lower(F.trim("segment")),
        "country": F.coalesce("country", F.lit("UNKNOWN")),
    }
    return quality.cleanse(views.all_customers(spark, sf_dir), rules)


# --- columns ------------------------------------------------------------------


def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return add_audit_columns(orders, "BATCH", batch_id="first").drop("load_timestamp")


def round_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = views.table(spark, sf_dir, "lineitem")
    profit = views.margin(F.col("l_extendedprice"), F.col("l_discount"))
    priced = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", profit.alias("profit"))
    return _plain(priced.withColumn("profit", round_money(F.col("profit"), priced.schema["profit"].dataType)))


def _written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates as text: some month first, some left empty."""
    shipped = F.col("l_shipdate")
    text = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit(""))
        .when(F.col("l_returnflag") == "N", F.date_format(shipped, "M/d/yyyy"))
        .otherwise(F.date_format(shipped, "d/M/yyyy"))
    )
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("ship_date")
    )


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dates(_written_dates(spark, sf_dir), ["ship_date"])


def date_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_parse_failures(_written_dates(spark, sf_dir), ["ship_date"])


# Headers as a careless supplier might send them.
AWKWARD_HEADERS = {
    "l_orderkey": " Order ID ",
    "l_linenumber": "Line - No",
    "l_partkey": "Part.ID",
    "l_extendedprice": "Prix (€)",
    "l_discount": "Discount%",
    "l_returnflag": "Return  Flag",
}


def sanitize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = views.table(spark, sf_dir, "lineitem").select(*AWKWARD_HEADERS)
    return sanitize_column_names(line.withColumnsRenamed(AWKWARD_HEADERS))


# --- upserts --------------------------------------------------------------------


def _before_and_last_day(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    newest = events.agg(F.max("batch_day")).scalar()
    return events.where(F.col("batch_day") < newest), latest_batch(events, "batch_day")


def _user_upsert(delete_when: Column | None = None) -> Query:
    def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
        earlier, today = _before_and_last_day(views.events(spark, sf_dir))
        target = latest_per_key(earlier, ["user_id"], "ts", ["event_id"])
        return merge_rows(target, today, ["user_id"], "ts", ["event_id"], delete_when=delete_when)

    return merged


def upsert_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_upsert(F.col("event_type") == "error")(spark, sf_dir)


def upsert_only_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views arrive late: they replace a purchase only if they happened after it."""
    events = views.events(spark, sf_dir)
    bought = latest_per_key(events.where("event_type = 'purchase'"), ["user_id"], "ts", ["event_id"])
    seen = events.where("event_type IN ('view', 'signup')")
    return merge_rows(bought, seen, ["user_id"], "ts", ["event_id"], only_if_newer=True)


def upsert_order_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging lines by order keeps one line per order: the last in a fixed order."""
    lines = views.order_lines(spark, sf_dir)
    rest = [c for c in views.LINE_COLUMNS if c not in ("order_id", "ship_date")]
    ordered = ["discount", *rest]
    return _plain(merge_rows(lines.where(F.lit(False)), lines, ["order_id"], "ship_date", ordered))


# --- sinks and sources, written to and read from the shared folder -----------------


@contextmanager
def _scratch_table(
    spark: SparkSession, like: DataFrame, partition_by: str | None = None, bucket_by: str | None = None
) -> Iterator[str]:
    """An external table that is forgotten afterwards; its files stay for the lazy result."""
    name = f"scratch_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    partitioned = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    bucketed = f"CLUSTERED BY ({bucket_by}) SORTED BY ({bucket_by}) INTO 8 BUCKETS" if bucket_by else ""
    folder = new_folder(spark, "table")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned} {bucketed} LOCATION '{folder}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, today = _before_and_last_day(views.events(spark, sf_dir))
    with _scratch_table(spark, earlier) as table:
        write_table(earlier, table, "append")
        write_table(today.select(*reversed(today.columns)), table, "append")
        return spark.table(table).select(*EVENT_COLUMNS)


def widened_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of three batches of lines whose columns come in ever other types, the last in the narrow ones again."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_tax")
    )
    year = F.year("l_shipdate")
    narrow = {"l_orderkey": "int", "l_linenumber": "smallint", "l_quantity": "int", "l_extendedprice": "decimal(12,2)", "l_shipdate": "date"}
    wide = {"l_extendedprice": "decimal(14,4)"}
    typed = lambda types: lines.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    first = typed(narrow).where(year <= 1999).drop("l_tax")
    with _scratch_table(spark, first) as table:
        write_table(first, table, "append")
        write_table(typed(wide).where(year == 2000), table, "append", evolve=True)
        write_table(typed(narrow).where((year > 2000) | year.isNull()), table, "append", evolve=True)
        return stage(_plain(read_table(spark, table)), "widened")


def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by part of its own contents."""
    events = views.events(spark, sf_dir)
    with _scratch_table(spark, events) as table:
        write_table(events, table, "append")
        write_table(spark.table(table).where("event_type <> 'error'"), table, "overwrite")
        return spark.table(table).select(*EVENT_COLUMNS)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "lineitem")
    lines = views.table(spark, sf_dir, "lineitem")
    write_parquet(lines, folder, partition_by=["l_returnflag", "l_linestatus"])
    return spark.read.parquet(folder).select(*lines.columns)


def upsert_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day's events merged into a stored table, twice."""
    earlier, today = _before_and_last_day(views.events(spark, sf_dir))
    with _scratch_table(spark, earlier) as table:
        write_table(latest_per_key(earlier, ["user_id"], "ts", ["event_id"]), table)
        for _ in range(2):
            upsert_table(today, table, ["user_id"], "ts", ["event_id"])
        return spark.table(table).select(*EVENT_COLUMNS)


def upsert_partitions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above into a table partitioned by day, where a user's row moves between partitions."""
    earlier, today = _before_and_last_day(views.events(spark, sf_dir))
    with _scratch_table(spark, earlier, "batch_day") as table:
        write_table(latest_per_key(earlier, ["user_id"], "ts", ["event_id"]), table)
        upsert_table(today, table, ["user_id"], "ts", ["event_id"])
        # partitions are listed in the catalog, which forgets them with the table
        return stage(spark.table(table).select(*EVENT_COLUMNS), "upserted")


def upsert_buckets_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above into buckets of users: first the users' own events bucket by bucket, then all, some without a user."""
    earlier, today = _before_and_last_day(views.events(spark, sf_dir))
    with _scratch_table(spark, earlier, bucket_by="user_id") as table:
        write_table(latest_per_key(earlier, ["user_id"], "ts", ["event_id"]), table)
        for batch in (today.where("user_id IS NOT NULL"), today):
            upsert_table(batch, table, ["user_id"], "ts", ["event_id"])
        return stage(spark.table(table).select(*EVENT_COLUMNS), "upserted")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = views.all_products(spark, sf_dir)
    folder = new_folder(spark, "csv")
    products.write.option("header", True).csv(folder)
    return read_delimited(spark, folder, products.schema)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.all_customers(spark, sf_dir)
    folder = new_folder(spark, "json")
    customers.write.json(folder)
    return read_json(spark, folder, customers.schema, multi_line=False)


def _good_and_rejects(scan: Scan) -> DataFrame:
    """All records of a source: rows as the schema reads them, rejects as raw text with their reason."""
    written = scan.of(stage(scan.judged, "judged"))
    return written.good.unionByName(written.rejects, allowMissingColumns=True)


PART_SCHEMA = T.StructType(
    [
        T.StructField("part_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as delimited text with doubled quotes, in which every tenth price, id or number of fields is wrong."""
    kind = F.col("p_partkey") % 10
    name = F.concat(F.lit('"'), "p_type", F.lit(', ""'), "p_name", F.lit('"""'))
    price = F.when(kind == 0, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    fields = [
        F.when(kind == 7, F.lit("")).otherwise(F.col("p_partkey").cast("string")),
        name,
        F.col("p_size").cast("string"),
        F.when(kind != 3, price),
        F.when(kind == 5, F.lit("more")),
    ]
    folder = new_folder(spark, "csv")
    # a field that is NULL is left out, which makes the line short
    views.table(spark, sf_dir, "part").select(F.concat_ws(",", *fields)).write.text(folder)
    return _good_and_rejects(scan_delimited(spark, folder, PART_SCHEMA, escape='"', required=["part_id"]))


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("priority", T.StringType()),
    ]
)


def _order_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as objects, with braces, quotes and backslashes in their texts."""
    quoted = F.concat(F.lit('{"'), "o_orderpriority", F.lit('"}\\ ['))
    fields = F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        quoted.alias("priority"),
    )
    return views.table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(fields).alias("object"))


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by line, in which some ids are texts or absent and some lines end early."""
    kind = F.col("o_orderkey") % 11
    text = (
        F.when(kind == 0, F.regexp_replace("object", '"customer_id":', '"customer_id":"none","was":'))
        .when(kind == 4, F.expr("left(object, length(object) - 1)"))
        .when(kind == 6, F.regexp_replace("object", '"order_id":', '"number":'))
        .otherwise(F.col("object"))
    )
    folder = new_folder(spark, "json")
    _order_objects(spark, sf_dir).select(text).write.text(folder)
    return _good_and_rejects(scan_json(spark, folder, ORDER_SCHEMA, required=["order_id"]))


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from files that each hold one array of several thousand objects."""
    objects = _order_objects(spark, sf_dir).withColumn("file", F.expr("o_orderkey div 5000"))
    arrays = objects.groupBy("file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("object"), ",\n"), F.lit("]")).alias("value")
    )
    folder = new_folder(spark, "json")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return _good_and_rejects(scan_json_array(spark, folder, ORDER_SCHEMA, required=["order_id"]))


def xlsx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.table(spark, sf_dir, "customer")
    return decode_workbooks(as_workbooks(customers), customers.schema)


QUERIES: dict[str, Query] = {
    "gold_profit_summary": gold_profit_summary,
    "incremental_gold": incremental_gold,
    "enrich_left": enrich_left,
    "silver_order": silver_order,
    "report_profit_by_year": _report("profit_by_year"),
    "report_profit_by_year_category": _report("profit_by_year_category"),
    "report_profit_by_customer": _report("profit_by_customer"),
    "report_profit_by_customer_year": _report("profit_by_customer_year"),
    "view_silver_order": _view(views.silver_lines),
    "view_gold_profit_summary": _view(gold_profit_summary),
    "view_customer": _view(views.customers),
    "view_product": _view(views.products),
    "latest_batch": latest_batch_events,
    "latest_per_key": latest_event_per_user,
    "dedupe_customer": dedupe_customer,
    "dedupe_product": dedupe_product,
    "duplicate_keys": repeated_line_keys,
    "null_profile": null_profile,
    "rule_summary": rule_summary,
    "rule_violations": rule_violations,
    "quality_limits": quality_limits,
    "orphans_customer": orphans_customer,
    "orphans_product": orphans_product,
    "orphan_count": orphan_count,
    "known_orders": known_orders,
    "quarantine": quarantine,
    "stage_counts": stage_counts,
    "cleansed_customers": cleansed_customers,
    "audit_stamp": audit_stamp,
    "round_profit": round_profit,
    "parse_dates": parsed_dates,
    "date_failures": date_failures,
    "sanitize_headers": sanitize_headers,
    "upsert_update_insert": _user_upsert(),
    "upsert_with_deletes": upsert_with_deletes,
    "upsert_only_newer": upsert_only_newer,
    "upsert_order_grain": upsert_order_grain,
    "append_roundtrip": append_roundtrip,
    "overwrite_roundtrip": overwrite_roundtrip,
    "widened_roundtrip": widened_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "upsert_table_roundtrip": upsert_table_roundtrip,
    "upsert_partitions_roundtrip": upsert_partitions_roundtrip,
    "upsert_buckets_roundtrip": upsert_buckets_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "xlsx_scan": xlsx_scan,
    "retail_run": retail_run,
    "running_gold": running_gold,
    "quarantine_release": quarantine_release,
    "ingest_run": ingest_run,
    "csv_rejects": csv_rejects,
    "json_rejects": json_rejects,
    "json_array_scan": json_array_scan,
    "ordered_profit_by_year": _ordered("profit_by_year"),
    "ordered_profit_by_year_category": _ordered("profit_by_year_category"),
    "ordered_profit_by_customer": _ordered("profit_by_customer"),
    "ordered_profit_by_customer_year": _ordered("profit_by_customer_year"),
}
