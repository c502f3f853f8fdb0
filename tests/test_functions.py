from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltstone.functions.audit import add_audit_columns, drop_audit_columns
from siltstone.functions.dates import date_parse_failures, parse_dates
from siltstone.functions.headers import sanitize_column_names, sanitize_name
from siltstone.functions.money import round_money


@pytest.mark.parametrize(
    "header, name",
    [
        ("Customer ID", "customer_id"),
        ("  Sub-Category ", "sub_category"),
        ("Price per product", "price_per_product"),
        ("a - b", "a__b"),
        ("A  B", "a_b"),
        ("Prix (€)", "prix__"),
        ("été", "_t_"),
        ("email", "email"),
    ],
)
def test_sanitize_name(header, name):
    assert sanitize_name(header) == name


def test_colliding_headers_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["A B", "A-B"])
    with pytest.raises(ValueError, match=r"\['a_b'\]"):
        sanitize_column_names(df)


def test_sanitize_keeps_order_and_rows(spark):
    df = spark.createDataFrame([(1, 2)], ["Row ID", "Part.No"])
    assert sanitize_column_names(df).columns == ["row_id", "part_no"]
    assert sanitize_column_names(df).collect() == [(1, 2)]


DATES = [("1/2/2016",), ("01/02/2016",), ("5/13/2016",), ("",), (None,), ("31/12/2016",)]


def test_parse_dates(spark):
    df = spark.createDataFrame(DATES, "d string")
    found = [r.d for r in parse_dates(df, ["d"]).collect()]
    assert found == [date(2016, 2, 1), date(2016, 2, 1), None, None, None, date(2016, 12, 31)]
    assert date_parse_failures(df, ["d"]).collect() == [("d", 2)]


def test_strict_dates_fail(spark):
    df = spark.createDataFrame(DATES, "d string")
    with pytest.raises(Exception, match="could not be parsed"):
        parse_dates(df, ["d"], strict=True).collect()


def test_audit_columns(spark):
    moment = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    df = spark.createDataFrame([("a", "old")], "k string, load_type string")
    stamped = add_audit_columns(df, "INCREMENTAL", moment, batch_id="b1")
    assert stamped.columns == ["k", "load_type", "load_timestamp", "batch_id"]
    row = stamped.first()
    assert (row.load_type, row.batch_id) == ("INCREMENTAL", "b1")
    assert stamped.where(F.col("load_timestamp") == F.lit(moment)).count() == 1
    assert drop_audit_columns(stamped).columns == ["k", "batch_id"]


def test_audit_defaults_and_guard(spark):
    df = spark.createDataFrame([("a",)], "k string")
    row = add_audit_columns(df).first()
    assert row.load_type == "FULL" and row.load_timestamp is not None
    with pytest.raises(ValueError, match=r"Invalid load_type 'DAILY'. Allowed: \['BATCH', 'FULL', 'INCREMENTAL'\]"):
        add_audit_columns(df, "DAILY")


@pytest.mark.parametrize(
    "value, rounded", [(1.005, 1.01), (-1.005, -1.01), (100.125, 100.13), (2.5, 2.5), (1.00499999999999, 1.0), (None, None)]
)
def test_round_money(spark, value, rounded):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(round_money(F.col("v"), df.schema["v"].dataType)).first()[0] == rounded
