"""Numbering rows in a global order without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.sinks.staging import stage

_PART, _AT, _BEFORE = "__part", "__at", "__before"

# Spark numbers rows within a partition in the low 33 bits.
_ROWS_OF_PART = (1 << 33) - 1


def with_positions(df: DataFrame, order_by: Sequence[Column], position: str = "position") -> DataFrame:
    """Rows with their place in the order, from 1.

    Rows are range-partitioned and sorted, every partition counts its own, and the counts of the partitions before
    are added. The sorted rows are written once, so that counts and numbers come from the same partitions. Only
    one row per partition passes through a single task. Rows that tie are numbered in any order: end ``order_by`` with a key.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = ordered.withColumns(
        {_PART: F.spark_partition_id(), _AT: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS_OF_PART))}
    )
    placed = stage(placed, "ordered")
    counts = placed.groupBy(_PART).agg(F.count("*").alias("n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    # one row per partition
    numbered = placed.join(F.broadcast(offsets), _PART)
    return numbered.select(*df.columns, (F.col(_BEFORE) + F.col(_AT) + 1).alias(position))
