"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import id_remainder
from siltstone.sinks.staging import stage

_WORD = re.compile(r"[^\W\d_]+")
# A term takes part in pairs from so many rows on.
LEAST_ROWS = 5
# While factors are searched for, every pair counts less in texts of more such terms, or the many
# pairs of long texts drown the weights. The last pass and scores count all pairs in full.
PAIR_TERMS = 60
# Factors that stay shorter than this are the noise they began as: such terms interact with none.
LEAST_FACTOR = 0.1
L1_OF_5000 = 15.0


def pair_share(paired: np.ndarray) -> float:
    return min(1.0, PAIR_TERMS / max(1, len(paired)))


def term_buckets(text: str | None, bits: int, start_letters: int = 5) -> np.ndarray:
    """Distinct hashed terms of a whole text: its words and how longer words begin, lower case."""
    words = set(_WORD.findall((text or "").lower()))
    terms = words | {w[:start_letters] + "~" for w in words if len(w) > start_letters}
    shift = 64 - bits
    return np.unique(np.array([xxhash.xxh3_64_intdigest(t) >> shift for t in terms], dtype=np.int64))


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)) over a text's terms.

    Pairs are those of terms that ``interact``, and count alike in texts of any length.
    """

    bias: float
    weight: np.ndarray
    factors: np.ndarray
    interact: np.ndarray
    bits: int

    def margin(self, terms: np.ndarray) -> float:
        v = self.factors[terms[self.interact[terms]]]
        pairs = 0.5 * (v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum()
        return float(self.bias + self.weight[terms].sum() + pairs)

    def score(self, text: str | None) -> float:
        margin = self.margin(term_buckets(text, self.bits))
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))))


@dataclass
class Learner:
    """Parameters under training: FTRL sums for the weights, AdaGrad sums for the factors.

    A weight is zero until its gradients add up to more than ``l1``, which a term met a few
    times doesn't reach. Terms that are ``often`` met take part in pairs, whatever their weights.
    With ``in_full`` only those do whose factors are LEAST_FACTOR long, and no pair is scaled: the model that scores.
    """

    bias: float
    pull: np.ndarray
    seen: np.ndarray
    factors: np.ndarray
    factors_seen: np.ndarray
    often: np.ndarray
    l1: float
    in_full: bool = False
    rate: float = 1.0
    l2: float = 0.01
    factor_rate: float = 0.05
    factor_decay: float = 0.05

    def weights(self, terms=slice(None)) -> np.ndarray:
        pull = self.pull[terms]
        free = pull - np.sign(pull) * self.l1
        return np.where(np.abs(pull) <= self.l1, 0.0, -free / (np.sqrt(self.seen[terms]) / self.rate + self.l2))

    def interacting(self) -> np.ndarray:
        return self.often & (np.linalg.norm(self.factors, axis=1) >= LEAST_FACTOR)

    def learn(self, terms: np.ndarray, label: float, cost: float, pairs: bool) -> None:
        weight = self.weights(terms)
        paired = terms[self.often[terms]] if pairs else terms[:0]
        share = 1.0 if self.in_full else pair_share(paired)
        v = self.factors[paired]
        total = v.sum(axis=0)
        margin = self.bias + weight.sum() + 0.5 * share * (total * total - (v * v).sum(axis=0)).sum()
        slope = (1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))) - label) * cost
        self.bias -= 0.05 * slope
        seen = self.seen[terms]
        self.pull[terms] += slope - (np.sqrt(seen + slope * slope) - np.sqrt(seen)) / self.rate * weight
        self.seen[terms] = seen + slope * slope
        if len(paired) > 1:
            step = share * (slope * (total - v) + self.factor_decay * abs(slope) * v)
            self.factors_seen[paired] += step * step
            self.factors[paired] -= self.factor_rate * step / np.sqrt(self.factors_seen[paired])

    def pass_over(self, rows: list[tuple[np.ndarray, float]], seed: int, pairs: bool) -> None:
        """All rows once, in a seeded order; both labels weigh the same, so that few toxic rows count.

        Without ``pairs`` only weights are learned.
        """
        toxic = min(max(float(np.mean([y for _, y in rows])), 1e-3), 1 - 1e-3)
        cost = {1.0: 0.5 / toxic, 0.0: 0.5 / (1 - toxic)}
        if self.in_full:
            self.often = self.interacting()
        for at in np.random.default_rng(seed).permutation(len(rows)):
            self.learn(*rows[at], cost[rows[at][1]], pairs)

    def packed(self) -> bytes:
        parts = [self.pull, self.seen, self.factors.ravel(), self.factors_seen.ravel(), np.array([self.bias])]
        return np.concatenate(parts).astype("<f4").tobytes()

    @staticmethod
    def mean(blocks: list[bytes], bits: int, rank: int, often: np.ndarray, l1: float) -> Learner:
        n = 1 << bits
        both = np.mean([np.frombuffer(b, "<f4") for b in blocks], axis=0, dtype=np.float64)
        pull, seen, factors, factors_seen, bias = np.split(both, [n, 2 * n, (2 + rank) * n, (2 + 2 * rank) * n])
        return Learner(float(bias[0]), pull, seen, factors.reshape(n, rank), factors_seen.reshape(n, rank), often, l1)


def sample_labels(marks: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` of (doc_id, label): half of each label where there are as many.

    Chosen by the hash of the id, so a rerun chooses the same.
    """
    sizes = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {label: min(1.0, sample_rows / 2 / max(1, sizes.get(label, 0))) for label in (0, 1)}
    wanted = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    return marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < wanted * 1_000_000)


def _rows_with(rows: DataFrame, size: int) -> np.ndarray:
    """How many rows hold each term; tasks send one row per term."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms in batch["terms"]:
                total[np.frombuffer(terms, "<i4")] += 1
        held = np.flatnonzero(total)
        yield pd.DataFrame({"term": held, "n": total[held]})

    counts = rows.select("terms").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(size, np.int64)
    for row in counts.collect():
        found[row.term] = row.n
    return found


def train_toxicity_model(
    labelled: DataFrame, bits: int = 16, rank: int = 4, part_rows: int = 5000, passes: int = 4, seed: int = 11
) -> FactorizationMachine:
    """Fit on a bounded number of rows with (text, label 0/1, pick); ``pick`` is any fixed hash of the row.

    The rows' hashed terms are dealt to parts of about ``part_rows``. In every pass a task
    per part goes on from the common parameters, and the results are averaged; the first pass
    learns weights alone, so that pairs learn what these leave, and the last one keeps the terms whose
    factors have grown and fits them with all pairs in full. Parameters have a fixed size, (2 + 2 x ``rank``) x 2**``bits``.
    """
    spark = labelled.sparkSession

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            terms = [term_buckets(text, bits).astype("<i4").tobytes() for text in batch["text"]]
            yield pd.DataFrame({"terms": terms, "label": batch["label"], "pick": batch["pick"]})

    rows = labelled.select("text", "label", "pick").mapInPandas(hashed, "terms binary, label int, pick long")
    # the texts are hashed once; passes read the terms
    rows = stage(rows, "terms")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    size = 1 << bits
    if len(sizes) < 2:
        # nothing to tell apart: the one label known, or even odds
        bias = {0: -2.0, 1: 2.0}.get(next(iter(sizes), None), 0.0)
        return FactorizationMachine(bias, np.zeros(size), np.zeros((size, rank)), np.zeros(size, bool), bits)
    parts = -(-sum(sizes.values()) // part_rows)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("pick", "terms"), F.lit(parts)))
    start = np.random.default_rng(seed).normal(0, 0.02, (size, rank))
    often = _rows_with(rows, size) >= LEAST_ROWS
    # gradients of a term that tells nothing add up to the root of the rows learned
    l1 = L1_OF_5000 * float(np.sqrt(sum(sizes.values()) / parts / 5000))
    state = Learner(0.0, np.zeros(size), np.zeros(size), start, np.ones((size, rank)), often, l1)

    def pass_of(shared, step_seed: int, with_pairs: bool, in_full: bool):
        def learn(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["pick", "terms"], ignore_index=True)
            pairs = [
                (np.frombuffer(t, "<i4").astype(np.int64), float(y)) for t, y in zip(group["terms"], group["label"])
            ]
            own = Learner.mean([shared.value], bits, rank, often, l1)
            own.in_full = in_full
            own.pass_over(pairs, step_seed, with_pairs)
            return pd.DataFrame({"block": [own.packed()]})

        return learn

    for number in range(passes):
        shared = spark.sparkContext.broadcast(state.packed())
        # one block of fixed size for each part
        learn = pass_of(shared, seed + number, number > 0, number == passes - 1)
        learned = dealt.groupBy("part").applyInPandas(learn, "block binary").collect()
        state = Learner.mean([bytes(row.block) for row in learned], bits, rank, often, l1)
        shared.unpersist()
    return FactorizationMachine(state.bias, state.weights(), state.factors, state.interacting(), bits)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The model learns from documents that ``labels`` (doc_id, toxic) marks 0 or 1, and whose
    crc32(doc_id) mod 5 is not 0; those at 0 are ``held_out``. A score uses the whole text
    alone. Null and empty texts have no terms: their score is that of the bias. Labels
    that are null or anything else teach nothing; a document with several labels is a row
    for each. Null ids are scored and teach nothing. An empty table gives no
    rows; other columns are ignored.
    """
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    marks = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(
        "doc_id", F.col("toxic").cast("int").alias("label")
    )
    marks = marks.where(id_remainder(F.col("doc_id"), 5) != 0)
    # about sample_rows ids, whatever the tables' size
    chosen = F.broadcast(sample_labels(marks, sample_rows))
    pick = F.xxhash64("doc_id", "text")
    labelled = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "label", pick.alias("pick"))
    model = docs.sparkSession.sparkContext.broadcast(train_toxicity_model(labelled))

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([model.value.score(text) for text in texts], dtype="float64")

    scored = F.pandas_udf(score, "double")
    return docs.select("doc_id", held_out.alias("held_out"), scored("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
