"""Recovering speaker roles in transcripts by a hidden Markov model, and rendering turns canonically."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import id_remainder
from siltstone.sinks.staging import stage

ROLES = ["system", "user", "assistant"]

# How transcripts name speakers, in lower case. Fixed values.
SPEAKERS = {
    "system": ["system", "instructions", "context"],
    "user": ["user", "human", "customer", "question", "q", "me"],
    "assistant": ["assistant", "ai", "bot", "agent", "answer", "a", "model"],
}
_NAMED = {name: 1 + k for k, role in enumerate(ROLES) for name in SPEAKERS[role]}
_MARKER = re.compile(
    r"^[ \t]*(?:[#>*\-\[<|]*[ \t]*)(" + "|".join(sorted(_NAMED, key=len, reverse=True)) + r")[ \t]*(?:\d+[ \t]*)?[\]>|*]*[:>][ \t*]*",
    re.IGNORECASE,
)
LENGTHS, MARKERS = 8, 1 + len(ROLES)
BLOCK_TURNS = 64


def segments(text: str) -> list[tuple[int, str]]:
    """(marker, body) of the parts of a text; a line that names a speaker starts a part, 0 is no name."""
    parts: list[tuple[int, list[str]]] = [(0, [])]
    for line in text.split("\n"):
        named = _MARKER.match(line)
        if named:
            parts.append((_NAMED[named.group(1).lower()], [line[named.end() :]]))
        else:
            parts[-1][1].append(line)
    found = [(marker, "\n".join(lines).strip()) for marker, lines in parts]
    return [p for p in found if p[0] or p[1]] or [(0, "")]


def features(marker: int, body: str) -> tuple[int, int, int, int]:
    """Marker, length class, whether it asks anywhere, whether it has several lines, code or a list."""
    words = len(body.split())
    asks = int("?" in body)
    laid_out = int("\n" in body or "```" in body)
    return marker, min(LENGTHS - 1, words.bit_length()), asks, laid_out


@dataclass(frozen=True)
class RoleModel:
    """Log-probabilities: of the first role, of the next given one, and of features given a role."""

    first: np.ndarray
    following: np.ndarray
    markers: np.ndarray
    lengths: np.ndarray
    asks: np.ndarray
    laid_out: np.ndarray

    def emission(self, marker: int, length: int, asks: int, laid_out: int) -> np.ndarray:
        return self.markers[:, marker] + self.lengths[:, length] + self.asks[:, asks] + self.laid_out[:, laid_out]


def _log_share(counts: np.ndarray, smoothing: float = 0.5) -> np.ndarray:
    counts = counts + smoothing
    return np.log(counts / counts.sum(axis=-1, keepdims=True))


def train_role_model(turns: DataFrame) -> RoleModel:
    """Count on rows (conv, turn, role, text) whose role is known; all counts are of fixed size.

    Names of speakers are trusted beforehand, as labelled rows need not have any.
    """
    known = turns.withColumn("role", F.array_position(F.array(*map(F.lit, ROLES)), F.lower("role")) - 1).where("role >= 0")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (role, *features(marker, body))
                for role, text in zip(batch["role"], batch["text"])
                for marker, body in segments(text or "")[:1]
            ]
            found = pd.DataFrame(rows, columns=["role", "marker", "length", "asks", "laid_out"])
            yield found.groupby(list(found.columns), as_index=False).size().rename(columns={"size": "n"})

    columns = ["role", "marker", "length", "asks", "laid_out"]
    schema = ", ".join(f"{c} long" for c in [*columns, "n"])
    seen = known.select("role", "text").mapInPandas(count, schema).groupBy(*columns).agg(F.sum("n").alias("n")).toPandas()
    markers, lengths = np.zeros((3, MARKERS)), np.zeros((3, LENGTHS))
    asks, laid_out = np.zeros((3, 2)), np.zeros((3, 2))
    trusted = 50.0
    markers[np.arange(3), np.arange(3) + 1] += trusted
    for role, marker, length, ask, out, n in seen.itertuples(index=False):
        markers[role, marker] += n
        lengths[role, length] += n
        asks[role, ask] += n
        laid_out[role, out] += n
    # what follows a turn, by its number: no conversation has to be in one place. Rows that share a turn number
    # are counted before they meet, and each counts once, in shares of the roles before it
    counts = [F.count(F.when(F.col("role") == role, 1)).alias(f"n{role}") for role in range(3)]
    spoken = known.where("turn IS NOT NULL").groupBy("conv", "turn").agg(*counts)
    before = spoken.select("conv", (F.col("turn") + 1).alias("turn"), *(F.col(f"n{role}").alias(f"b{role}") for role in range(3)))
    pairs = spoken.join(before, ["conv", "turn"], "left")
    share = "sum(cast(n{1} * b{0} / (b0 + b1 + b2) AS decimal(28, 6)))"
    sums = [F.expr(f"sum(CASE WHEN b0 IS NULL THEN n{role} END)") for role in range(3)]
    sums += [F.expr(share.format(last, role)) for last in range(3) for role in range(3)]
    found = np.array([float(value or 0) for value in pairs.agg(*sums).first()])
    first, following = found[:3], found[3:].reshape(3, 3)
    return RoleModel(*map(_log_share, (first, following, markers, lengths, asks, laid_out)))


def best_path(start: np.ndarray, emissions: np.ndarray, following: np.ndarray, last: int | None = None) -> list[int]:
    """Viterbi: the most probable states, given log-scores of the first state; ties go to the first role."""
    score, back = start + emissions[0], []
    for emission in emissions[1:]:
        reach = score[:, None] + following
        back.append(reach.argmax(axis=0))
        score = reach.max(axis=0) + emission
    path = [int(score.argmax()) if last is None else last]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def block_scores(emissions: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Best score through a block, by the state before it and its last state."""
    score = following + emissions[0]
    for emission in emissions[1:]:
        score = (score[:, :, None] + following[None]).max(axis=1) + emission
    return score


def recover_roles(conversations: DataFrame, model: RoleModel | None = None) -> DataFrame:
    """(conv_id, turn, segment, role_pred, text, rendered): one row per segment of (conv_id, turn, text).

    A text may hold the turns of several speakers; it is cut at lines that name one. Roles come from
    all segments of a conversation by Viterbi. A conversation of any length is cut into
    blocks of BLOCK_TURNS turn numbers: a block sends its best scores by the state before it and its last state,
    which join to the best states at the cuts, and then blocks are resolved on their
    own. That finds the same path as one run over the whole.

    The model is fitted on rows whose ``role`` is known, of conversations with crc32(conv_id) mod 5 other than 0,
    unless one is given. ``role`` is not used for prediction.

    Order is by turn, nulls first, and text. A null text is an empty turn. Rows with a null conv_id are
    conversations of their own. Repeated rows stay. An empty table gives no rows; other
    columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    conv = F.coalesce(
        F.concat(F.lit("="), F.col("conv_id").cast("string")),
        F.concat(F.lit("?"), F.xxhash64("turn", text).cast("string")),
    )
    rows = conversations.withColumn("__conv", conv)
    if model is None:
        taught = rows.where(id_remainder(F.col("conv_id"), 5) != 0)
        model = train_role_model(
            taught.select(F.col("__conv").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
        )
    shared = conversations.sparkSession.sparkContext.broadcast(model)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (conv, conv_id, turn, block, number, body, *features(marker, body))
                for conv, conv_id, turn, block, text in batch.itertuples(index=False)
                for number, (marker, body) in enumerate(segments(text))
            ]
            names = ["conv", "conv_id", "turn", "block", "segment", "body", "marker", "length", "asks", "laid_out"]
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"conv_id": "string", "turn": "Int64"})

    schema = (
        "conv string, conv_id string, turn long, block long, segment int, body string,"
        " marker int, length int, asks int, laid_out int"
    )
    turn = F.col("turn").cast("long")
    parts = rows.select(
        F.col("__conv").alias("conv"),
        F.col("conv_id").cast("string").alias("conv_id"),
        turn.cast("string").alias("turn"),
        F.floor(F.coalesce(turn, F.lit(0)) / BLOCK_TURNS).alias("block"),
        text.alias("text"),
    ).mapInPandas(split, schema)
    parts = stage(parts, "segments")

    def ordered(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        group = group.sort_values(["turn", "segment", "body"], na_position="first", kind="stable", ignore_index=True)
        scores = [shared.value.emission(*f) for f in group[["marker", "length", "asks", "laid_out"]].itertuples(index=False)]
        return group, np.array(scores)

    def summarise(group: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        group, scores = ordered(group)
        # from the start of a conversation, the state before makes no difference
        begin = block_scores(scores, np.tile(model.first, (3, 1)))[0] if len(scores) == 1 else None
        if begin is None:
            score = (model.first + scores[0])[None, :]
            for emission in scores[1:]:
                score = (score[:, :, None] + model.following[None]).max(axis=1) + emission
            begin = score[0]
        through = block_scores(scores, model.following)
        head = group[["conv", "block"]].head(1)
        return head.assign(begin=[begin.tolist()], through=[through.ravel().tolist()])

    blocks = parts.select("conv", "block", "turn", "segment", "body", "marker", "length", "asks", "laid_out")
    sums = blocks.groupBy("conv", "block").applyInPandas(
        summarise, "conv string, block long, begin array<double>, through array<double>"
    )
    sums = stage(sums, "blocks")
    # only conversations of several blocks have cuts to decide
    several = sums.groupBy("conv").agg(F.count("*").alias("blocks")).where("blocks > 1").select("conv")

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block", ignore_index=True)
        score, back = np.array(group["begin"].iat[0]), []
        for through in group["through"].iloc[1:]:
            reach = score[:, None] + np.array(through).reshape(3, 3)
            back.append(reach.argmax(axis=0))
            score = reach.max(axis=0)
        last = [int(score.argmax())]
        for step in reversed(back):
            last.append(int(step[last[-1]]))
        last = last[::-1]
        return group[["conv", "block"]].assign(before=[-1, *last[:-1]], last=last)

    cuts = sums.join(several, "conv", "left_semi").groupBy("conv").applyInPandas(
        cut, "conv string, block long, before int, last int"
    )
    placed = parts.join(cuts, ["conv", "block"], "left")

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        group, scores = ordered(group)
        before, last = group["before"].iat[0], group["last"].iat[0]
        start = model.first if pd.isna(before) or before < 0 else model.following[int(before)]
        path = best_path(start, scores, model.following, None if pd.isna(last) else int(last))
        roles = [ROLES[k] for k in path]
        rendered = [f"<|{role}|>\n{body}\n<|end|>" for role, body in zip(roles, group["body"])]
        out = group[["conv_id", "turn", "segment"]].assign(role_pred=roles, text=group["body"], rendered=rendered)
        return out.astype({"turn": "Int64"})

    found = placed.groupBy("conv", "block").applyInPandas(
        resolve, "conv_id string, turn long, segment int, role_pred string, text string, rendered string"
    )
    return found.withColumn("conv_id", F.col("conv_id").cast(conversations.schema["conv_id"].dataType))
