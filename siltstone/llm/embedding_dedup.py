"""Near-duplicate embeddings by counting window collisions on one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import attach_groups, components
from siltstone.sinks.staging import stage

CELL_ROWS = 256
CHUNK_ROWS = 1000
RECALL = 0.995
COLLISIONS = 2
WINDOW = 2.0


@dataclass(frozen=True)
class Projections:
    """``tables`` sorted projections; each splits rows by the signs of ``bits`` more projections first."""

    tables: int
    bits: int
    width: float
    threshold: float
    seed: int

    def directions(self, dim: int) -> np.ndarray:
        return np.random.default_rng([self.seed, dim]).normal(size=(dim, self.tables * (self.bits + 1)))

    def of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and places, both rows x tables."""
        values = (unit @ self.directions(unit.shape[1])).reshape(len(unit), self.tables, self.bits + 1)
        codes = (values[:, :, 1:] > 0) @ (1 << np.arange(self.bits, dtype=np.int64))
        return codes.astype(np.int64), values[:, :, 0]


def calibrated(largest: int, threshold: float, seed: int = 5) -> Projections:
    """As many sign bits as bring groups of ``largest`` rows to CELL_ROWS, and as many tables as RECALL takes.

    At the threshold, a pair's places differ by a normal variate whose deviation is the
    distance of the unit vectors, and a sign agrees with probability 1 - angle / pi. A pair
    collides in a table if all signs agree and the places are within the window. The number of
    collisions is binomial; COLLISIONS of them are asked for.
    """
    bits = max(0, math.ceil(math.log2(max(1, largest) / CELL_ROWS)))
    distance = math.sqrt(2 - 2 * threshold)
    collides = (1 - math.acos(threshold) / math.pi) ** bits * math.erf(WINDOW / math.sqrt(2))

    def missed(tables: int) -> float:
        return sum(
            math.comb(tables, k) * collides**k * (1 - collides) ** (tables - k) for k in range(COLLISIONS)
        )

    tables = COLLISIONS
    while missed(tables) > 1 - RECALL:
        tables += 1
    return Projections(tables, bits, WINDOW * distance, threshold, seed)


def collide(
    codes: np.ndarray, places: np.ndarray, vectors: np.ndarray, table: int, spec: Projections, chunk: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of one cell; ``chunk`` is 0 for all, or pairs are between 0 and 1 only.

    Rows are sorted by their place. The candidates of a query are the rows after it in its
    window; a pair counts its collisions in all tables, and only the first table of a
    pair takes it, so every pair is taken once. Pairs with enough collisions are verified.
    """
    order = np.argsort(places[:, table], kind="stable")
    codes, places, vectors, chunk = codes[order], places[order], vectors[order], chunk[order]
    at = places[:, table]
    ends = np.searchsorted(at, at + spec.width, "right")
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    both = bool(chunk.any())
    left, right = [], []
    step = 256
    for first in range(0, len(at), step):
        last = min(first + step, len(at))
        stop = ends[last - 1]
        rows, others = np.arange(first, last), np.arange(first, stop)
        pair = (others[None, :] > rows[:, None]) & (others[None, :] < ends[rows][:, None])
        if both:
            pair &= chunk[rows][:, None] != chunk[others][None, :]
        count = np.zeros(pair.shape, np.int16)
        for t in range(spec.tables):
            met = np.abs(places[rows, t][:, None] - places[others, t][None, :]) <= spec.width
            met &= codes[rows, t][:, None] == codes[others, t][None, :]
            count += met
            if t < table:
                pair &= ~met
        i, j = np.nonzero(pair & (count >= COLLISIONS))
        i, j = rows[i], others[j]
        for at_pair in range(0, len(i), 100_000):
            a, b = i[at_pair : at_pair + 100_000], j[at_pair : at_pair + 100_000]
            cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
            left.append(order[a[cosine >= spec.threshold]])
            right.append(order[b[cosine >= spec.threshold]])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each, by pulling labels down until none changes."""
    label = np.arange(size)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def embedding_components(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Vectors link when their labels are equal and not null and their cosine in double
    precision is at least ``threshold``. Every pair found is verified; pairs are found with
    the probability RECALL or more at the threshold, and more above it (see ``calibrated``).
    All vectors are indexed and all are queries.

    Equal vectors are one row with a size first, so a large group of copies costs a row; pairs
    are counted and joined to stars within a task, never returned. A cell of signs with more
    than two CHUNK_ROWS rows is dealt by chunk pairs, so a task compares 2 CHUNK_ROWS rows at most.

    Vectors that are null, empty, zero or hold nulls or values that are not finite, and those
    without a label, link with nothing. Vectors of different lengths don't link. Every row is a vector
    of its own, whatever its vec_id: rows that share one are linked by their cosine only. A null vec_id links like any
    other; a component without any id has a null one. Classes are told apart by 64-bit hashes. An empty table gives no rows;
    other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), F.col("label").cast("string"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & some
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("sig", F.sha2(F.concat_ws("|", "label", F.col("embedding").cast("string")), 256))
    rows = stage(rows, "vectors")
    # equal signatures have equal vectors, so any of them will do
    classes = rows.where("usable").groupBy("sig").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding")
    )
    distinct = stage(classes.withColumn("node", F.xxhash64("sig")), "classes")
    sizes = distinct.select("sig", "node", "rep", "copies")
    members = attach_groups(rows.select("vec_id", "sig", "usable"), sizes.where("copies > 1"), ["sig"], "copies", rows.count())
    members = stage(
        members.select(
            "vec_id",
            # what links with nothing has a name of its own, so that such rows don't meet in one task
            F.when(F.col("usable"), F.xxhash64("sig")).otherwise(F.xxhash64("vec_id", F.lit("alone"))).alias("node"),
            F.coalesce(F.when(F.col("usable"), F.col("rep")), F.col("vec_id")).alias("rep"),
            F.coalesce(F.when(F.col("usable"), F.col("copies")), F.lit(1)).alias("copies"),
        ),
        "members",
    )
    largest = distinct.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    spec = calibrated(largest, threshold)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, group in batch.groupby(batch["embedding"].map(len)):
                raw = np.stack(group["embedding"].to_list()).astype(np.float64)
                scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
                unit = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
                codes, places = spec.of(unit)
                yield pd.DataFrame(
                    {
                        "node": group["node"], "label": group["label"], "copies": group["copies"], "dim": dim,
                        "codes": list(codes), "places": [p.tobytes() for p in places],
                        "vector": [v.tobytes() for v in scaled],
                    }
                )

    schema = "node long, label string, copies long, dim int, codes array<long>, places binary, vector binary"
    projected = stage(distinct.select("node", "label", "copies", "embedding").mapInPandas(project, schema), "projected")
    cell = ["label", "dim", "table", "code"]
    coded = projected.select("*", F.posexplode("codes").alias("table", "code"))
    large = coded.groupBy(*cell).agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * CHUNK_ROWS)
    large = stage(large.select(*cell, F.ceil(F.col("rows") / CHUNK_ROWS).alias("chunks")), "large")
    dealt = coded.join(large, cell, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "chunks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable", ignore_index=True)
        codes = np.stack(group["codes"].to_list())
        places = np.stack([np.frombuffer(p) for p in group["places"]])
        raw = np.stack([np.frombuffer(v) for v in group["vector"]])
        chunk = (group["own"] != group["low"]).to_numpy().astype(np.int8)
        left, right = collide(codes, places, raw, int(group["table"].iat[0]), spec, chunk)
        copies = group["copies"].to_numpy()
        links = np.zeros(len(group), np.int64)
        np.add.at(links, left, copies[right])
        np.add.at(links, right, copies[left])
        hit = np.flatnonzero(links)
        ids = group["node"].to_numpy()
        roots = _roots(len(group), left, right)
        return pd.DataFrame({"node": ids[hit], "links": links[hit], "root": ids[roots[hit]]})

    met = dealt.groupBy(*cell, "low", "high").applyInPandas(compare, "node long, links long, root long")
    met = stage(met, "met")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # the smallest id of a component's members; its own name is a hash
    named = groups.join(sizes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    groups = groups.join(named, "component").select("node", "least")
    found = members.join(counts, "node", "left").join(groups, "node", "left")
    component = F.coalesce("least", "rep")
    return found.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
