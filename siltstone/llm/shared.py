"""Helpers that several corpus operators use."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sinks.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A group above 1/HOT_SHARE of all rows is hot; there are HOT_SHARE of them at most.
HOT_SHARE = 1000

FILTER_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only, unlike ``lower``, which follows Unicode."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def attach_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int, strategy: str | None = None
) -> DataFrame:
    """Left-join ``rows`` to one row per group on ``keys``; ``size`` counts a group's rows.

    Groups above 1/HOT_SHARE of ``total`` rows are broadcast: they are HOT_SHARE at most,
    whatever the input. The others have too few rows each to skew a shuffled join;
    ``strategy`` is Spark's hint for it.
    """
    limit = max(1, total // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col(size) > limit))
    of_hot = rows.join(hot, list(keys), "inner")
    others = rows.join(hot.select(*keys), list(keys), "left_anti")
    rest = groups.where(F.col(size) <= limit)
    return of_hot.unionByName(others.join(rest.hint(strategy) if strategy else rest, list(keys), "left"))


def filter_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def bitmap_of(rows: DataFrame, column: str, bit: Column | None = None) -> np.ndarray:
    """A filter of FILTER_BITS bits, whatever the input, that knows all values of a column.

    ``bit`` is a value's bit, by default ``filter_bit``. The filter lets other values through the more, the fuller it is; what passes is joined as usual.
    """
    # Spark numbers the bits of its maps from 1
    bits = rows.select(((filter_bit(column) if bit is None else bit) + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    maps = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    whole = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    # all at once, 8 MB at most: an iterator would run a job for every partition
    found = maps.toArrow()
    for bucket, part in zip(found.column("bucket").to_pylist(), found.column("map")):
        part = np.frombuffer(part.as_buffer(), np.uint8)
        whole[(bucket - 1) * len(part) : bucket * len(part)] = part
    return whole


def in_bitmap(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def components(links: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = stage) -> DataFrame:
    """(node, component): the smallest node reachable; only linked nodes are returned.

    ``links`` has the columns a and b, in any order. In every round each node points to
    its smallest neighbour, pointers are followed twice over, and links are redrawn
    between what they point to, until none is left. Every round is written to the
    shared folder by ``stage``, so no lineage builds up; the driver only asks whether links remain.
    """

    def redrawn(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return stage(ends.where("a < b").distinct(), "links")

    def follow(pointers: DataFrame, onwards: DataFrame) -> DataFrame:
        then = onwards.select(F.col("node").alias("target"), F.col("target").alias("then"))
        return pointers.join(then, "target", "left").select(
            "node", F.coalesce("then", "target").alias("target")
        )

    links = redrawn(links)
    found = None
    while not links.isEmpty():
        ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("target"))
        step = stage(step.withColumn("target", F.least("node", "target")), "pointers")
        step = stage(follow(step, step.where("node <> target")), "pointers")
        moved = step.where("node <> target")
        found = step if found is None else stage(follow(found, moved), "pointers")
        at_a = moved.select(F.col("node").alias("a"), F.col("target").alias("to_a"))
        at_b = moved.select(F.col("node").alias("b"), F.col("target").alias("to_b"))
        links = redrawn(
            links.join(at_a, "a", "left")
            .join(at_b, "b", "left")
            .select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
        )
    if found is None:
        found = links.select(F.col("a").alias("node"), F.col("b").alias("target"))
    return found.withColumnRenamed("target", "component")
