"""Source-file schemas and stored tables of the retail model.

Fixed values: column names, order and types below are the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

from siltstone.functions.headers import sanitize_name
from siltstone.operators.running import STATE_TYPES
from siltstone.sinks.ddl import TableSpec


def _schema(columns: dict[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, t, c not in required) for c, t in columns.items()])


_TEXT, _INT, _DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()

customer_schema = _schema(
    {
        "Customer ID": _TEXT,
        "Customer Name": _TEXT,
        "email": _TEXT,
        "phone": _TEXT,
        "address": _TEXT,
        "Segment": _TEXT,
        "Country": _TEXT,
        "City": _TEXT,
        "State": _TEXT,
        "Postal Code": _TEXT,
        "Region": _TEXT,
    },
    required=("Customer ID", "Customer Name"),
)

product_schema = _schema(
    {
        "Product ID": _TEXT,
        "Category": _TEXT,
        "Sub-Category": _TEXT,
        "Product Name": _TEXT,
        "State": _TEXT,
        "Price per product": _DOUBLE,
    },
    required=("Product ID",),
)

order_schema = _schema(
    {
        "Row ID": _INT,
        "Order ID": _TEXT,
        "Order Date": _TEXT,
        "Ship Date": _TEXT,
        "Ship Mode": _TEXT,
        "Customer ID": _TEXT,
        "Product ID": _TEXT,
        "Quantity": _INT,
        "Price": _DOUBLE,
        "Discount": _DOUBLE,
        "Profit": _DOUBLE,
    },
    required=("Row ID", "Order ID"),
)

ORDER_DATES = ["order_date", "ship_date"]
CUSTOMER_ATTRIBUTES = ["customer_name", "country"]
PRODUCT_ATTRIBUTES = ["category", "sub_category"]
PROFIT_PLACES = 2
PROFIT_KEYS = ["year", "category", "sub_category", "customer_name"]
BATCH_COLUMN = "batch_id"
ORDER_LINE_KEYS = ["order_id", "row_id"]

_AUDIT = _schema({"load_timestamp": T.TimestampType(), "load_type": _TEXT})


def _stored(source: T.StructType, dates: list[str] | None = None) -> T.StructType:
    """A source schema under its stored names, with parsed dates and audit columns."""
    dates = dates or []
    fields = []
    for source_field in source:
        name = sanitize_name(source_field.name)
        data_type = T.DateType() if name in dates else source_field.dataType
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields + _AUDIT.fields)


def _extended(schema: T.StructType, columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType(schema.fields + _schema(columns).fields)


_customer = _stored(customer_schema)
_product = _stored(product_schema)
_order = _stored(order_schema, ORDER_DATES)


def _raw(name: str, schema: T.StructType) -> TableSpec:
    """Raw history, one partition per batch: the newest batch is read without the older ones."""
    return TableSpec(name, _extended(schema, {BATCH_COLUMN: _TEXT}), partition_by=[BATCH_COLUMN])


bronze_customer = _raw("bronze_customer", _customer)
bronze_product = _raw("bronze_product", _product)
bronze_order = _raw("bronze_order", _order)

silver_customer = TableSpec(
    "silver_customer", _customer, cluster_by=["customer_id", "country"], view="vw_silver_customer"
)
silver_product = TableSpec(
    "silver_product", _product, cluster_by=["product_id", "category"], view="vw_silver_product"
)
silver_order = TableSpec(
    "silver_order",
    _extended(_order, {c: _TEXT for c in CUSTOMER_ATTRIBUTES + PRODUCT_ATTRIBUTES}),
    cluster_by=["customer_id", "product_id", "order_date"],
    view="vw_silver_order",
)
quarantine_orphan_orders = TableSpec(
    "quarantine_orphan_orders", _extended(_order, {"reject_reason": _TEXT})
)
gold_profit_summary = TableSpec(
    "gold_profit_summary",
    T.StructType(
        [
            *_schema({"year": _INT, "category": _TEXT, "sub_category": _TEXT, "customer_name": _TEXT}),
            *_schema({"total_profit": _DOUBLE}),
            *_AUDIT,
        ]
    ),
    cluster_by=["year", "category", "customer_name"],
    view="vw_gold_profit_summary",
)

# What the summary is kept up to date by (``operators.running``).
gold_profit_state = TableSpec(
    "gold_profit_state",
    T.StructType([*(f for f in gold_profit_summary.schema if f.name in PROFIT_KEYS), *_schema(STATE_TYPES)]),
)

# Records of the source files that do not fit their schema.
ingest_rejects = TableSpec(
    "ingest_rejects",
    T.StructType([*_schema({"feed": _TEXT, "raw": _TEXT, "reason": _TEXT}), *_AUDIT, *_schema({BATCH_COLUMN: _TEXT})]),
    partition_by=[BATCH_COLUMN],
)

# One row per finished batch, written last; batches without one are not read.
ingest_ledger = TableSpec(
    "ingest_ledger",
    T.StructType(
        [
            *_schema({BATCH_COLUMN: _TEXT}),
            *_schema({c: T.LongType() for c in ("customers", "products", "orders", "rejects")}),
            *_AUDIT,
        ]
    ),
)

ALL_TABLES = [
    bronze_customer,
    bronze_product,
    bronze_order,
    silver_customer,
    silver_product,
    silver_order,
    quarantine_orphan_orders,
    gold_profit_summary,
    gold_profit_state,
    ingest_rejects,
    ingest_ledger,
]
