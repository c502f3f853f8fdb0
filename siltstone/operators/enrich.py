"""Star-schema enrichment and the split of facts with unknown keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.money import round_money
from siltstone.operators.joins import fits_broadcast, join_dimension

REJECT_REASON = "reject_reason"


@dataclass(frozen=True)
class DimensionLink:
    """How a fact refers to a dimension that holds one row per ``dim_key``.

    ``key_rows`` is a cheaper place to look for heavy keys (see ``join_dimension``).
    """

    dim: DataFrame
    fact_key: str
    attributes: Sequence[str] = ()
    dim_key: str | None = None
    reason: str | None = None
    key_rows: DataFrame | None = None

    @property
    def key(self) -> str:
        return self.dim_key or self.fact_key

    @property
    def reject_reason(self) -> str:
        return self.reason or f"unknown {self.fact_key}"


def enrich_star(
    fact: DataFrame,
    links: Iterable[DimensionLink],
    round_columns: Sequence[str] = (),
    scale: int = 2,
    how: str = "left",
    fits: Sequence[bool] | None = None,
) -> DataFrame:
    """Join the attributes of each dimension.

    An unknown key gives NULL attributes, or with ``how="inner"`` drops the row. ``fits`` is the outcome of ``fits_broadcast``
    for the dimensions if the caller has it already.
    """
    bare, links = fact, list(links)
    tables = [link.dim.select(link.key, *link.attributes) for link in links]
    for link, table, small in zip(links, tables, fits_broadcast(tables) if fits is None else fits):
        # heavy keys are looked for in the facts before any join, not in the chain so far
        key_rows = bare if link.key_rows is None else link.key_rows
        fact = join_dimension(fact, table, {link.fact_key: link.key}, how, key_rows, fits=small)
    rounded = {c: round_money(F.col(c), fact.schema[c].dataType, scale) for c in round_columns}
    return fact.withColumns(rounded) if rounded else fact


def mark_known(
    fact: DataFrame,
    links: Sequence[DimensionLink],
    round_columns: Sequence[str] = (),
    scale: int = 2,
    fits: Sequence[bool] | None = None,
) -> tuple[DataFrame, list[Column]]:
    """Enriched facts, and per link a condition that its key is known. One join per dimension."""
    flags = [f"__known_{n}" for n in range(len(links))]
    marked = [
        replace(
            link,
            dim=link.dim.select(link.key, *link.attributes).withColumn(flag, F.lit(True)),
            attributes=[*link.attributes, flag],
        )
        for flag, link in zip(flags, links)
    ]
    joined = enrich_star(fact, marked, round_columns, scale, fits=fits)
    return joined, [F.col(flag).isNotNull() for flag in flags]


def classify(
    fact: DataFrame, links: Iterable[DimensionLink], round_columns: Sequence[str] = (), scale: int = 2
) -> DataFrame:
    """Enriched facts with ``reject_reason``: NULL if every key is known, else the first unknown one.

    Each dimension is joined once and serves both the check and the
    attributes; the caller filters or partitions by the reason.
    """
    links = list(links)
    marked, known = mark_known(fact, links, round_columns, scale)
    reasons = [F.when(~is_known, F.lit(link.reject_reason)) for is_known, link in zip(known, links)]
    attributes = [a for link in links for a in link.attributes]
    return marked.select(*fact.columns, *attributes, F.coalesce(*reasons).alias(REJECT_REASON))


def orphan_count(fact: DataFrame, links: Iterable[DimensionLink]) -> DataFrame:
    """Rows ``(check_name, orphans)``, one per fact key, from one pass over the facts.

    Where a dimension is too large to broadcast, no fact is shuffled: each task counts its facts by key, for all links at once,
    and the keys with their counts are joined. A key that a third of all facts have is one row of a task then.
    """
    keys_only = [replace(l, dim=l.dim.select(l.key).distinct(), attributes=()) for l in links]
    names = [link.fact_key for link in keys_only]
    fits = fits_broadcast([link.dim.withColumn("__known", F.lit(True)) for link in keys_only])
    if all(fits):
        marked, known = mark_known(fact, keys_only, fits=fits)
        unknown = [F.count_if(~is_known) for is_known in known]
    else:
        keys = list(dict.fromkeys(names))
        absent = {k: f"__absent_{n}" for n, k in enumerate(keys)}
        # a row counts the facts of a value of one key; it is absent from the sets of the others
        counted = fact.groupingSets([[F.col(k)] for k in keys], *keys).agg(
            F.count("*").alias("__facts"), *(F.grouping(k).alias(a) for k, a in absent.items())
        )
        # counted keys are one row each, so there are no heavy ones to look for
        even = fact.select(*keys).where(F.lit(False))
        marked, known = mark_known(counted, [replace(link, key_rows=even) for link in keys_only], fits=fits)
        unknown = [
            F.coalesce(F.sum(F.when(~is_known & (F.col(absent[n]) == 0), F.col("__facts"))), F.lit(0).cast("long"))
            for is_known, n in zip(known, names)
        ]
    counts = marked.agg(*(count.alias(n) for count, n in zip(unknown, names)))
    return counts.unpivot([], names, "check_name", "orphans")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)


def rejected(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quarantine rows: the fact's own ``columns`` and the reason."""
    return classified.where(F.col(REJECT_REASON).isNotNull()).select(*columns, REJECT_REASON)


def split_orphans(
    fact: DataFrame, links: Iterable[DimensionLink]
) -> tuple[DataFrame, DataFrame]:
    """``(known facts, quarantine rows)``; together they are exactly the input.

    Both frames come from one plan. Write the classified frame once
    (``classify``) when both are needed and the fact is large.
    """
    classified = classify(fact, [replace(link, attributes=()) for link in links])
    return accepted(classified), rejected(classified, fact.columns)


def replayable(rejects: DataFrame, links: Iterable[DimensionLink], stamp: str) -> DataFrame:
    """Quarantined facts that may be known by now: the key they were rejected for has arrived.

    Only dimension rows stamped after the oldest rejected fact are looked at, and only the facts rejected for that dimension.
    A fact with several unknown keys comes up when the first of them arrives, and is classified anew.
    """
    oldest = rejects.agg(F.min(stamp)).scalar()
    found = None
    for link in links:
        arrived = link.dim.where(F.col(stamp) > oldest).select(link.key).distinct()
        waiting = rejects.where(F.col(REJECT_REASON) == link.reject_reason)
        known = join_dimension(waiting, arrived, {link.fact_key: link.key}, "left_semi")
        found = known if found is None else found.unionByName(known)
    return found
