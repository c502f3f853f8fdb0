"""Exact deduplication by an extendible-hash index on shared files. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.shared import ascii_lower, attach_groups
from siltstone.sinks.staging import stage

# Parts of the rows in which copies meet before they go to the owner of their bucket.
PARTS = 16
RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def _prefix(key: Column, depth: int) -> Column:
    """The top ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The directory (slot, bucket) of an extendible hash table over ``keys``, and its depth.

    ``keys`` holds distinct 64-bit keys. The directory starts as deep as an even spread
    needs. While a bucket holds more than ``capacity`` keys the directory doubles: such
    buckets split in two, and the others are pointed at by twice as many slots. Buckets are
    numbered in key order, by their lowest slot; slots of empty buckets are left out. The driver sees only whether any bucket is
    overfull.
    """
    depth = max(0, (max(1, keys.count()) - 1) // capacity).bit_length()
    full = keys.groupBy(_prefix(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("keys"))
    full = stage(full, "buckets")
    leaves = full.where(F.col("keys") <= capacity).select("prefix", F.lit(depth).alias("depth"))
    full = full.where(F.col("keys") > capacity)
    while not full.isEmpty() and depth < 64:
        placed = keys.withColumn("prefix", _prefix(F.col("key"), depth))
        inside = placed.join(full.select("prefix"), "prefix", "left_semi")
        depth += 1
        halves = inside.groupBy(_prefix(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("keys"))
        halves = stage(halves, "buckets")
        done = (F.col("keys") <= capacity) if depth < 64 else F.lit(True)
        leaves = leaves.unionByName(halves.where(done).select("prefix", F.lit(depth).alias("depth")))
        full = halves.where(~done)
    first = F.expr(f"shiftleft(prefix, {depth} - depth)")
    last = F.expr(f"shiftleft(prefix, {depth} - depth) + shiftleft(1L, {depth} - depth) - 1")
    slots = leaves.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"))
    return stage(slots, "directory"), depth


def build_index(docs: DataFrame, capacity: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The index of all texts and the entries that ask it, both written to the shared folder.

    The index has one row per distinct text: bucket, key, chain, text_sha256, keep_id,
    group_size, keep_rows. Texts whose 64-bit keys collide are told apart by comparing
    their bytes and chained. A bucket, which is a range of keys, is grouped and written by the one
    task that owns it.
    """
    rows = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    entries = stage(rows.select("doc_id", "key", F.sha2("text", 256).alias("text_sha256")), "entries")
    directory, depth = grow_directory(stage(rows.select("key").distinct(), "keys"), capacity)
    # Copies meet first within a part of the rows, so that a hot text doesn't travel whole to its owner.
    parts = rows.groupBy("key", "text", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part")).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("n")
    )
    # The directory names the bucket of a key; its owner, one task, compares bytes, counts and chains.
    routed = parts.withColumn("slot", _prefix(F.col("key"), depth)).join(directory, "slot").repartition("bucket")
    texts = routed.groupBy("bucket", "key", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    owned = (
        texts.select("bucket", "key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        .withColumn("chain", F.row_number().over(chain))
        .select("bucket", "key", "chain", "text_sha256", "keep_id", "group_size")
        .sortWithinPartitions("bucket", "key", "chain")
    )
    return stage(owned, "index"), entries


def exact_groups(docs: DataFrame, capacity: int = 1024) -> DataFrame:
    """One row per row of ``docs``: RESULT.

    Texts are equal when they are after lower-casing A-Z. Of equal texts the largest doc_id
    stays. Nulls count as empty texts. A null doc_id is below all others; ``keep_id`` is
    null if a group has no other. Of rows that repeat the doc_id that stays, one stays. An
    empty table gives no rows; other columns are ignored.

    ``capacity`` is the number of keys in a bucket of the index.
    """
    index, entries = build_index(docs, capacity)
    groups = index.where("group_size > 1").select("key", "text_sha256", "keep_id", "group_size")
    found = attach_groups(entries, groups, ["key", "text_sha256"], "group_size", entries.count())
    alone = found.where("group_size IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    copies = found.where("group_size IS NOT NULL")
    is_largest = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # one such row in each group, unless ids repeat
    first = F.row_number().over(Window.partitionBy("text_sha256").orderBy("group_size")) == 1
    largest = copies.where(is_largest).withColumn("kept", first)
    others = copies.where(~is_largest).withColumn("kept", F.lit(False))
    return alone.unionByName(largest.unionByName(others).select(*RESULT))


def drop_copies(docs: DataFrame, capacity: int = 1024) -> DataFrame:
    """The rows of ``docs`` that stay by ``exact_groups``, with their columns and texts as they were."""
    kept = exact_groups(docs, capacity).where("kept")
    keys = {
        "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "__sha": F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256),
    }
    kept = kept.select(keys["__id"].alias("__id"), F.col("text_sha256").alias("__sha"))
    # the join has brought rows with equal keys together, so that repeated rows meet as well
    repeats = Window.partitionBy(*keys).orderBy(F.lit(1))
    return (
        docs.withColumns(keys)
        .join(kept, list(keys), "left_semi")
        .withColumn("__n", F.row_number().over(repeats))
        .where("__n = 1")
        .select(*docs.columns)
    )
