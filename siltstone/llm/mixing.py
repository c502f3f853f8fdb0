"""Mixing sources to target weights by Sainte-Laguë apportionment. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.operators.joins import join_dimension
from siltstone.sinks.staging import stage

RESULT = ["doc_id", "size", "source_size", "target", "taken"]

# Words as the contract of sizes has them. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"

# A null source is a source of its own; joins need it as two columns that are never null.
_KEY = ["source", "no_source"]


def _ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows from 0 in a global order, without bringing them into one task.

    Range partitions are numbered, counted, and offset by the counts before them; the driver
    and the window over counts see one row per partition.
    """
    parts = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    parts = stage(parts, "ranges")
    counts = parts.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (
        parts.withColumn("__within", within)
        .join(F.broadcast(offsets), "__part")  # one row per shuffle partition at most
        .withColumn(name, F.col("__before") + F.col("__within"))
        .drop("__part", "__within", "__before")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), ceiling: float = 3.0) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, no_source, source_size, ...), one row per source.

    Sources in code point order, null last, get the weights in turn. Targets share the total
    size by weight. No target passes ``ceiling`` times its source's size: what is over is
    shared among the others by weight, again and again until none is above.
    """
    rows = _ranked(sizes, ["no_source", "source"], "place")
    among = F.array(*[F.lit(float(w)) for w in weights])
    rows = rows.withColumn("weight", F.element_at(among, (F.col("place") % len(weights) + 1).cast("int")))
    rows = stage(rows.drop("place"), "sources")
    limit = F.col("source_size") * F.lit(float(ceiling))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        # sources at their ceiling under the share found last leave the rest to the others
        full = F.col("weight") * share > limit
        taken, weight, number = rows.agg(
            F.sum(F.when(full, limit).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.sum(F.when(full, 1).otherwise(0)),
        ).first()
        if not weight:
            break
        share = (total - taken) / weight
        if rows.where((F.col("weight") * share > limit)).count() <= (number or 0):
            break
    return rows.withColumn("target", F.least(F.col("weight") * share, limit) if share else limit)


def apportion(
    rows: DataFrame, within: Sequence[str], order: Sequence[str], seats: str, size: str, most: str
) -> DataFrame:
    """Sainte-Laguë: add ``quota``, the share of each row in the ``seats`` of its group.

    A row of size s has the quotients s/1, s/3, s/5, ...; the highest quotients of a group,
    as many as it has seats, each give one. That is rounding s/d to the nearest integer
    for some divisor d. Rounding with d = total size / seats misses the number of seats
    by half the rows at most, so only the quotients next to that are listed: those not
    below the last one that is sure to be needed. Ties go by ``order``. No row gets more
    than ``most``.
    """
    group = Window.partitionBy(*within)
    rows = rows.withColumn("__total", F.sum(size).over(group))
    plain = F.when(F.col("__total") > 0, F.col(size) * F.col(seats) / F.col("__total")).otherwise(0.0)
    rows = rows.withColumn("__base", F.least(F.col(most), F.floor(plain + 0.5).cast("long")))
    rows = rows.withColumn("__missing", F.col(seats) - F.sum("__base").over(group))
    # the next quotient up where seats are missing, the last one given where there are too many
    up = F.col("__missing") > 0
    room = F.when(up, F.col(most) - F.col("__base")).otherwise(F.col("__base"))
    odd = F.when(up, 2 * F.col("__base") + 1).otherwise(2 * F.col("__base") - 1)
    rows = rows.withColumn("__room", F.when(F.col(size) > 0, room).otherwise(0))
    rows = rows.withColumn("__next", F.when(F.col("__room") > 0, F.col(size) / odd))
    rank = [F.when(up, -F.col("__next")).otherwise(F.col("__next")).asc_nulls_last(), *order]
    rows = rows.withColumn("__rank", F.row_number().over(group.orderBy(*rank)))
    needed = F.abs("__missing")
    edge = F.max(F.when(F.col("__rank") == needed, F.col("__next"))).over(group)
    rows = rows.withColumn("__edge", edge)
    # how many quotients of a row lie on the needed side of the edge
    reach = F.when(up, F.floor((F.col(size) / F.col("__edge") + 1) / 2) - F.col("__base")).otherwise(
        F.col("__base") - F.ceil((F.col(size) / F.col("__edge") - 1) / 2)
    )
    listed = F.least(F.col("__room"), needed, F.greatest(F.coalesce(reach, needed), F.lit(1)))
    listed = F.when((needed > 0) & F.col("__next").isNotNull(), listed).otherwise(0).cast("int")
    changed = rows.withColumn("__listed", listed)
    step = (
        changed.where("__listed > 0")
        .withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__listed") - 1)))
        .withColumn(
            "__quotient",
            F.when(up, -F.col(size) / (2 * (F.col("__base") + F.col("__k")) + 1)).otherwise(
                F.col(size) / (2 * (F.col("__base") - F.col("__k")) - 1)
            ),
        )
    )
    chosen = F.row_number().over(group.orderBy("__quotient", *order, "__k")) <= F.abs("__missing")
    keys = list(dict.fromkeys([*within, *order]))
    step = step.withColumn("__chosen", chosen).where("__chosen").groupBy(*keys, "__missing").agg(F.count("*").alias("__n"))
    step = step.select(*keys, (F.signum("__missing") * F.col("__n")).cast("long").alias("__more"))
    out = rows.join(step, keys, "left").withColumn("quota", F.col("__base") + F.coalesce("__more", F.lit(0)))
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    ceiling: float = 3.0,
    block_words: int = 16,
    shard_rows: int = 1000,
    seed: int = 7,
) -> DataFrame:
    """How often the words of each document are taken into a mix of the size of all: RESULT.

    Size is the number of words. Each source's target is found by ``source_targets``. The
    mix is made of blocks of ``block_words`` words, which ``apportion`` allocates to sources by
    their targets, and within a source to shards of about ``shard_rows`` documents by their
    sizes. A shard's documents in doc_id order are one run of words, cut into blocks; its
    quota gives every block as many whole turns as there are, and one more to blocks spread
    evenly from a seeded start. ``taken`` counts the words of a document in the blocks
    taken, repeats counted, and is at most ``ceiling`` times its size.

    A shard is chosen by the hash of id and text, so a source of any size spreads over
    tasks, and a rerun takes the same. Null texts have size 0; a null source is a source, the
    last. Null ids come first in a shard. Repeated rows are documents of their own. An empty
    table gives no rows; other columns are ignored.
    """
    return _taken(docs, weights, ceiling, block_words, shard_rows, seed).select(*RESULT)


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` as ``mix_sources`` takes them, with their columns: a row for each turn of a document.

    A part of a turn becomes a whole one with that probability, by a seeded hash, and else none. Documents
    without words are not taken. Rows equal in id and text get their mean.
    """
    taken = _taken(docs, seed=seed).where("size > 0")
    chance = F.pmod(F.xxhash64("hash", F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    turns = taken.withColumn("turns", F.floor(F.col("taken") / F.col("size") + chance))
    turns = turns.groupBy(F.col("hash").alias("__hash")).agg(F.round(F.avg("turns")).cast("int").alias("__turns"))
    keyed = docs.withColumn("__hash", F.xxhash64("doc_id", "text"))
    kept = keyed.join(turns.where("__turns > 0"), "__hash")
    return kept.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__turns")))).select(*docs.columns)


def _taken(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    ceiling: float = 3.0,
    block_words: int = 16,
    shard_rows: int = 1000,
    seed: int = 7,
) -> DataFrame:
    """RESULT and the hash of id and text."""
    turns = int(ceiling)
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("source").isNull().alias("no_source"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("doc_id", "text").alias("hash"),
    )
    rows = stage(rows, "sizes")
    sizes = rows.groupBy(*_KEY).agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    targets = source_targets(sizes, weights, ceiling)
    targets = stage(targets.withColumn("shards", F.ceil(F.col("docs") / shard_rows)), "targets")
    rows = join_dimension(
        rows,
        targets.select(*_KEY, "shards", "source_size", "target"),
        {k: k for k in _KEY},
        key_rows=rows.select(*_KEY),
    )
    rows = rows.withColumn("shard", F.pmod("hash", "shards"))
    cell = [*_KEY, "shard"]
    blocks = lambda words: F.ceil(F.col(words) / block_words)
    cells = stage(rows.groupBy(*cell).agg(F.sum("size").alias("cell_size")), "cells")

    total = F.round(F.sum("source_size").over(Window.partitionBy("all")) / block_words).cast("long")
    room = cells.groupBy(*_KEY).agg(F.sum(turns * blocks("cell_size")).alias("most"))
    by_source = targets.join(room, _KEY).withColumn("all", F.lit(0)).withColumn("seats", total)
    by_source = apportion(by_source, ["all"], _KEY, "seats", "target", "most")
    by_source = stage(by_source.select(*_KEY, F.col("quota").alias("seats")), "quotas")
    by_cell = cells.withColumn("most", turns * blocks("cell_size")).join(by_source, _KEY)
    quotas = apportion(by_cell, _KEY, cell, "seats", "cell_size", "most")
    quotas = stage(quotas.select(*cell, "quota", blocks("cell_size").alias("blocks")), "quotas")

    upto = Window.partitionBy(*cell).orderBy("doc_id", "hash").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum("size").over(upto)).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.join(quotas, cell)
    start_at = F.pmod(F.xxhash64(*cell, F.lit(seed)), F.greatest("blocks", F.lit(1)))
    whole = F.floor(F.col("quota") / F.greatest("blocks", F.lit(1)))
    rows = rows.withColumn("whole", whole).withColumn("extra", F.col("quota") - whole * F.col("blocks"))
    rows = rows.withColumn("shift", start_at * F.col("extra"))

    def extras_before(block):
        """Blocks before this one that have one more turn."""
        return F.floor((block * F.col("extra") + F.col("shift")) / F.greatest("blocks", F.lit(1)))

    def words_before(position):
        """Words of such blocks before a position of the run."""
        block = F.floor(position / block_words)
        here = extras_before(block + 1) - extras_before(block)
        return extras_before(block) * block_words + here * (position - block * block_words)

    taken = F.col("whole") * F.col("size") + words_before(F.col("end")) - words_before(F.col("start"))
    return rows.select("doc_id", "hash", "size", "source_size", "target", taken.cast("long").alias("taken"))
