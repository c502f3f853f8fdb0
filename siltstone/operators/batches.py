"""Picking one batch out of an appended history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch(df: DataFrame, batch_column: str = "load_timestamp") -> DataFrame:
    """Rows of the newest batch; none if the history is empty.

    The maximum is a scalar subquery inside the same query, so nothing travels
    through the driver's time zone. When ``batch_column`` is a partition
    column, Spark evaluates the subquery first and lists only that partition.
    """
    newest = df.agg(F.max(batch_column)).scalar()
    return df.where(F.col(batch_column) == newest)
