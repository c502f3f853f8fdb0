import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.workbook_samples import as_workbooks, workbook_bytes
from siltstone.retail import transforms
from siltstone.retail.schemas import customer_schema, product_schema
from siltstone.sources.catalog import read_latest_batch, read_table, table_partitions
from siltstone.sources.files import read_delimited, read_json
from siltstone.sources.workbooks import read_workbooks, workbook_rows

PRODUCT_HEADER = "Product ID,Category,Sub-Category,Product Name,State,Price per product\n"


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


# --- delimited text ---------------------------------------------------------------


def test_products(spark, tmp_path):
    path = _write(
        tmp_path / "p.csv",
        PRODUCT_HEADER + 'P1,Furniture,Chairs,"Oak, solid",NY,12.5\nP2,Furniture,Chairs,Pine,NY,cheap\nP3,Toys\n',
    )
    rows = transforms.read_products(spark, path).orderBy("product_id").collect()
    assert rows[0] == ("P1", "Furniture", "Chairs", "Oak, solid", "NY", 12.5)
    assert rows[1].price_per_product is None
    assert rows[2] == ("P3", "Toys", None, None, None, None)


def test_quotes_need_the_matching_escape(spark, tmp_path):
    path = _write(tmp_path / "p.csv", PRODUCT_HEADER + 'P1,A,B,"6"" shelf",NY,1\n')
    (by_default,) = read_delimited(spark, path, product_schema).collect()
    assert by_default["Product Name"] != '6" shelf'
    (doubled,) = read_delimited(spark, path, product_schema, escape='"').collect()
    assert doubled["Product Name"] == '6" shelf'


def test_columns_bind_by_position_unless_asked(spark, tmp_path):
    path = _write(tmp_path / "p.csv", "b,a\n1,2\n")
    schema = "a string, b string"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b")])
    assert read_delimited(spark, path, schema).collect() == [("1", "2")]
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, path, schema, by_position=False).collect()


def test_corrupt_lines_can_be_kept(spark, tmp_path):
    path = _write(tmp_path / "p.csv", "a\n1\nx\n")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    rows = read_delimited(spark, path, schema, corrupt_column="bad").cache().collect()
    assert rows == [(1, None), (None, "x")]


# --- JSON ---------------------------------------------------------------------------

ORDERS = [
    {"Row ID": 1, "Order ID": "O1", "Order Date": "1/2/2016", "Ship Date": "13/2/2016", "Ship Mode": "Air",
     "Customer ID": "C1", "Product ID": "P1", "Quantity": 7, "Price": 10.5, "Discount": 0.1, "Profit": 1.25},
    {"Row ID": 2, "Order ID": "O1", "order date": "1/2/2016", "Ship Date": "5/13/2016", "Quantity": "7", "Profit": 2},
    {"Row ID": 3, "Order ID": "O2", "Quantity": 2.5},
]


@pytest.mark.parametrize("multi_line", [True, False])
def test_orders(spark, tmp_path, multi_line):
    text = json.dumps(ORDERS, indent=1) if multi_line else "\n".join(map(json.dumps, ORDERS))
    path = _write(tmp_path / "o.json", text)
    first, second, third = transforms.read_orders(spark, path, multi_line).orderBy("row_id").collect()
    assert (str(first.order_date), str(first.ship_date), first.quantity) == ("2016-02-01", "2016-02-13", 7)
    assert (first.price, first.discount, first.profit) == (10.5, 0.1, 1.25)
    # other spelling, other type, impossible date, absent field: NULL
    assert (second.order_date, second.ship_date, second.quantity, second.customer_id) == (None,) * 4
    assert second.profit == 2.0
    assert third.quantity is None


def test_bad_dates_fail_when_strict(spark, tmp_path):
    path = _write(tmp_path / "o.json", json.dumps(ORDERS))
    with pytest.raises(Exception, match="5/13/2016"):
        transforms.read_orders(spark, path, strict_dates=True).collect()


def test_read_json_schema(spark, tmp_path):
    path = _write(tmp_path / "o.json", '[{"a": 1, "A": 2}]')
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert read_json(spark, path, schema).collect() == [(1,)]


# --- workbooks ------------------------------------------------------------------------

HEADERS = [f.name for f in customer_schema]


def _customer(n, **changes):
    row = {h: f"{h} {n}" for h in HEADERS} | changes
    return [row[h] for h in HEADERS]


def test_customers(spark, tmp_path):
    for n in range(3):
        rows = [_customer(f"{n}-{i}") for i in range(4)]
        (tmp_path / f"c{n}.xlsx").write_bytes(workbook_bytes(HEADERS, rows))
    df = transforms.read_customers(spark, str(tmp_path))
    assert df.columns[:2] == ["customer_id", "customer_name"]
    assert df.count() == 12
    assert df.where("customer_id = 'Customer ID 2-3'").first().postal_code == "Postal Code 2-3"


def test_cells_bind_by_header_and_may_be_absent(spark, tmp_path):
    headers = ["Region", " Customer ID ", "Unknown"]
    rows = [["West", "<C&1>", "?"], [None, "C2", None], [None, None, None]]
    (tmp_path / "c.xlsx").write_bytes(workbook_bytes(headers, rows))
    found = transforms.read_customers(spark, str(tmp_path / "c.xlsx")).orderBy("customer_id")
    assert [(r.customer_id, r.region, r.email) for r in found.collect()] == [
        ("<C&1>", "West", None), ("C2", None, None),
    ]


def test_cell_kinds(tmp_path):
    """Shared and rich strings, formula results, booleans, errors, numbers, skipped cells."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = (
        f"<sst {main}><si><t>head</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>"
    )
    sheet = (
        f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row>'
        '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2" t="b"><v>1</v></c><c r="D2" t="e"><v>#N/A</v></c>'
        '<c r="E2" t="str"><f>1+1</f><v>two</v></c><c r="AA2"><v>60601</v></c><c r="AB2"/></row>'
        '<row r="3"/><row r="4"><c><v>1.5</v></c><c><v>2</v></c></row></sheetData></worksheet>'
    )
    path = tmp_path / "b.xlsx"
    path.write_bytes(workbook_bytes(["x"], []))
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts |= {"xl/worksheets/sheet1.xml": sheet.encode(), "xl/sharedStrings.xml": strings.encode()}
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    rows = list(workbook_rows(path.read_bytes()))
    assert rows == [{0: "head"}, {0: "rich", 2: "true", 4: "two", 26: "60601"}, {}, {0: "1.5", 1: "2"}]
    assert list(workbook_rows(path.read_bytes(), "Sheet1")) == rows
    with pytest.raises(ValueError, match="no sheet 'Other'"):
        list(workbook_rows(path.read_bytes(), "Other"))


def test_typed_columns_and_bad_text(spark, tmp_path):
    (tmp_path / "n.xlsx").write_bytes(workbook_bytes(["n", "d"], [[3, 0.1], ["three", 2]]))
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DoubleType())])
    found = read_workbooks(spark, str(tmp_path), schema).orderBy("d").collect()
    assert found == [(3, 0.1), (None, 2.0)]


def test_one_workbook_per_batch(spark, conf):
    conf(**{"spark.sql.execution.arrow.maxRecordsPerBatch": "100"})
    books = as_workbooks(spark.range(1000, numPartitions=2).select(F.col("id").cast("string").alias("id")))
    assert books.count() == 10


def test_read_table(spark, customer_df):
    customer_df.createOrReplaceTempView("some_customers")
    assert read_table(spark, "some_customers").count() == 2


@pytest.fixture
def parted(spark):
    spark.sql("CREATE TABLE parted (v int, d date, s string) USING parquet PARTITIONED BY (d, s)")
    yield "parted"
    spark.sql("DROP TABLE parted")


def test_partitions_come_from_the_catalog(spark, parted):
    rows = [(1, "2024-01-01", "a/b=c d+e%"), (2, "2024-01-02", None), (3, "2024-01-02", "it's"), (4, None, "é")]
    df = spark.createDataFrame(rows, "v int, d string, s string").withColumn("d", F.col("d").cast("date"))
    df.select("v", "d", "s").write.insertInto(parted)
    listed = table_partitions(spark, parted)
    assert set(listed.collect()) == set(spark.table(parted).select("d", "s").distinct().collect())
    assert "FileScan" not in listed._jdf.queryExecution().executedPlan().toString()


def test_latest_batch_of_a_partitioned_table(spark, parted):
    assert read_latest_batch(spark, parted, "d").count() == 0
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, "2024-01-02", None)], "v int, d string, s string")
    df.select("v", F.col("d").cast("date"), "s").write.insertInto(parted)
    newest = read_latest_batch(spark, parted, "d")
    assert sorted(r.v for r in newest.collect()) == [2, 3]
    assert "d=2024-01-01" not in " ".join(newest.inputFiles())
