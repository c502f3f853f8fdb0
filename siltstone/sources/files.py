"""Delimited text and JSON scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    escape: str = "\\",
    by_position: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Text with a header line. A bad number becomes NULL, a short line ends in NULLs.

    Columns bind by position; ``by_position=False`` fails when the header
    names differ from the schema. ``escape='"'`` reads doubled quotes as one.
    ``corrupt_column`` names a string column that receives malformed lines.
    Lines are split across tasks.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("escape", escape)
        .option("enforceSchema", by_position)
    )
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """JSON objects bound by exact field name; an absent or ill-typed field becomes NULL.

    ``multi_line`` reads each file as one document, in one task. Deliver large
    feeds as one object per line and pass False: those files are split.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
