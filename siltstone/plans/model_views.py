"""The star-schema tables read as the retail model.

Orphans are not made up: customers in debt and discontinued (large) parts are
missing from the curated dimensions, and pending orders of unspecified
priority are guest orders without a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.enrich import DimensionLink, enrich_star
from siltstone.operators.joins import join_dimension
from siltstone.retail.schemas import CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES

# Identifies a line: (order_id, line_no) repeats in the given data.
LINE_COLUMNS = [
    "order_id", "line_no", "product_id", "supplier_id", "quantity", "price", "order_date", "ship_date",
]


_INT, _LONG, _DOUBLE, _TEXT, _TIME = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
)

# Declared, so that opening a table runs no job to infer its columns.
TABLES = {
    "nation": {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT},
    "customer": {
        "c_custkey": _LONG, "c_name": _TEXT, "c_nationkey": _INT, "c_acctbal": _DOUBLE, "c_mktsegment": _TEXT,
    },
    "part": {
        "p_partkey": _LONG, "p_name": _TEXT, "p_brand": _TEXT, "p_type": _TEXT, "p_size": _INT,
        "p_retailprice": _DOUBLE,
    },
    "orders": {
        "o_orderkey": _LONG, "o_custkey": _LONG, "o_orderstatus": _TEXT, "o_totalprice": _DOUBLE,
        "o_orderdate": _TIME, "o_orderpriority": _TEXT,
    },
    "lineitem": {
        "l_orderkey": _LONG, "l_partkey": _LONG, "l_suppkey": _LONG, "l_linenumber": _INT,
        "l_quantity": _DOUBLE, "l_extendedprice": _DOUBLE, "l_discount": _DOUBLE, "l_tax": _DOUBLE,
        "l_returnflag": _TEXT, "l_linestatus": _TEXT, "l_shipdate": _TIME,
    },
    "events": {
        "event_id": _LONG, "ts": _TIME, "user_id": _LONG, "event_type": _TEXT, "value": _DOUBLE, "props": _TEXT,
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, t) for c, t in TABLES[name].items()])
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def margin(price: Column, discount: Column) -> Column:
    """6% list margin less the discount given, exact to four decimals; many lines lose money."""
    return price.cast("decimal(12,2)") * (
        F.lit("0.06").cast("decimal(4,2)") - discount.cast("decimal(4,2)")
    )


def _guest() -> Column:
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")


def customer_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of all orders: shows heavy customers without joining the lines."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.when(~_guest(), F.col("o_custkey")).alias("customer_id"))


def product_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    lines = join_dimension(
        table(spark, sf_dir, "lineitem"), orders, {"l_orderkey": "o_orderkey"}, "inner"
    )
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.when(~_guest(), F.col("o_custkey")).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        margin(F.col("l_extendedprice"), F.col("l_discount")).alias("profit"),
    )


def all_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 nations at every scale
    nations = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    customers = table(spark, sf_dir, "customer")
    customers = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left")
    return customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated customers: those in good standing."""
    return all_customers(spark, sf_dir).where("balance >= 0").drop("balance")


def all_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price_per_product"),
        F.col("p_size").alias("size"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated products: those still offered."""
    return all_products(spark, sf_dir).where("size <= 45").drop("size")


def links(spark: SparkSession, sf_dir: str) -> list[DimensionLink]:
    return [
        DimensionLink(
            customers(spark, sf_dir),
            "customer_id",
            CUSTOMER_ATTRIBUTES,
            key_rows=customer_key_rows(spark, sf_dir),
        ),
        DimensionLink(
            products(spark, sf_dir),
            "product_id",
            PRODUCT_ATTRIBUTES,
            key_rows=product_key_rows(spark, sf_dir),
        ),
    ]


def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known lines, enriched, profit rounded to cents (still decimal)."""
    return enrich_star(order_lines(spark, sf_dir), links(spark, sf_dir), ["profit"], how="inner")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw batches by day; a visitor who signs up has no user id yet."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") != "signup", F.col("user_id")).alias("user_id"),
        "event_type",
        "value",
        F.col("ts").cast("date").alias("batch_day"),
    )
