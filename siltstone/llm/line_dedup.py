"""Dropping lines whose template recurs across documents, by a fixed-depth log-template tree."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import FILTER_BITS, attach_groups, bitmap_of, filter_bit, in_bitmap
from siltstone.llm.shingles import slices
from siltstone.sinks.staging import stage

VARIABLE = "<*>"
LEADING_TOKENS = 3
SIMILAR = 0.7
CHUNK_LINES = 2000
IDLE_ROUNDS = 2
# Share of a template's tokens that must not be variable: numbers alone are no evidence of a template.
LEAST_CONSTANT = 0.25

_VARIABLE = re.compile(r"\d")


def line_tokens(line: str) -> list[str]:
    """White-space tokens; those with a digit are variable fields."""
    return [VARIABLE if _VARIABLE.search(t) else t for t in line.split()]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def leaf_of(tokens: list[str]) -> int:
    """Where the tree of fixed depth leads: by the number of tokens, then by the leading ones."""
    return _hash("\x1f".join([str(len(tokens)), *tokens[:LEADING_TOKENS]]))


def line_keys(text: str) -> dict[int, int]:
    """{line hash: leaf} of the lines of a text that hold any token; equal token lists are one line."""
    keys = {}
    for line in dict.fromkeys(text.split("\n")):
        tokens = line_tokens(line)
        if tokens:
            keys[_hash("\x1f".join(tokens))] = leaf_of(tokens)
    return keys


def grow_templates(lines: list[list[str]], starts: list[list[str]] = ()) -> tuple[list[list[str]], list[int]]:
    """Templates of one leaf, and the template of each line; all lines have the same number of tokens.

    A line joins the template that most of its tokens equal, if SIMILAR of them do, and the
    tokens in which they differ become variable; else it starts a template.
    """
    templates = [list(t) for t in starts]
    numbers: dict[str, int] = {VARIABLE: 0}
    coded = [[numbers.setdefault(t, len(numbers)) for t in x] for x in templates]
    width = len(lines[0]) if lines else 0
    held = np.zeros((max(16, len(coded) + 16), width), np.int64)
    if coded:
        held[: len(coded)] = coded
    number, place = len(coded), []
    for tokens in lines:
        code = np.array([numbers.setdefault(t, len(numbers)) for t in tokens])
        equal = (held[:number] == code).sum(axis=1)
        best = int(equal.argmax()) if number else -1
        if number and equal[best] >= SIMILAR * width:
            differs = held[best] != code
            held[best][differs] = 0
            for k in np.flatnonzero(differs):
                templates[best][k] = VARIABLE
        else:
            if number == len(held):
                held = np.concatenate([held, np.zeros_like(held)])
            held[number] = code
            templates.append(list(tokens))
            best, number = number, number + 1
        place.append(best)
    return templates, place


def dealt_templates(kinds: DataFrame, number: int) -> DataFrame:
    """``kinds`` (leaf, template, lines) with chunk; no chunk has many more than CHUNK_LINES templates.

    A leaf of up to CHUNK_LINES is one chunk, 0. The templates of a larger one are dealt by one token after the leading
    ones, another in each round, and where very many have the same by the next token as well, and then by
    all tokens.
    """
    sizes = kinds.groupBy("leaf").agg(F.count("*").alias("__n"))
    large = stage(sizes.where(F.col("__n") > CHUNK_LINES), "large")
    total = kinds.count()
    rows = attach_groups(kinds, large, ["leaf"], "__n", total)
    small = rows.where("__n IS NULL").withColumn("chunk", F.lit("0"))
    # the tokens are turned, so that another one is the first after the leading ones in every round
    rest = F.slice(F.split("template", "\x1f"), LEADING_TOKENS + 1, 1 << 30)
    first = F.pmod(F.lit(number), F.greatest(F.size(rest), F.lit(1)))
    turned = F.concat(F.slice(rest, first + 1, F.size(rest)), F.slice(rest, F.lit(1), first))
    open_rows = rows.where("__n IS NOT NULL").withColumn("__turned", turned)
    # few templates of one token share a chunk with those of others; many get chunks of their own
    open_rows = open_rows.withColumn("__token", F.xxhash64(F.slice("__turned", 1, 1)))
    open_rows = stage(open_rows.withColumn("__two", F.xxhash64(F.slice("__turned", 1, 2))).drop("__turned"), "turned")
    for key in ("__token", "__two"):
        counts = open_rows.groupBy("leaf", key).agg(F.count("*").alias(f"{key}_n"))
        often = stage(counts.where(F.col(f"{key}_n") > CHUNK_LINES), "often")
        open_rows = attach_groups(open_rows, often, ["leaf", key], f"{key}_n", total)

    def part(size: str, of: str):
        return F.pmod(F.xxhash64(of), F.ceil(F.col(size) / CHUNK_LINES))

    by_token = F.concat_ws(":", F.lit("t"), part("__n", "__token"))
    by_two = F.concat_ws(":", F.lit("u"), "__token", part("__token_n", "__two"))
    by_all = F.concat_ws(":", F.lit("v"), "__two", part("__two_n", "template"))
    chunk = F.when(F.col("__token_n").isNull(), by_token).when(F.col("__two_n").isNull(), by_two).otherwise(by_all)
    columns = ["leaf", "template", "lines", "chunk"]
    return small.select(*columns).unionByName(open_rows.withColumn("chunk", chunk).select(*columns))


def merge_templates(kinds: DataFrame) -> DataFrame:
    """(leaf, template, final) for every row of ``kinds`` (leaf, template, lines): templates of a leaf that agree become one.

    Rounds of chunks: in each, the templates of a chunk are grown into fewer. A leaf is done when one
    chunk holds it. The others go on until their number has not fallen for IDLE_ROUNDS rounds.
    """

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lines", "template"], ascending=[False, True], ignore_index=True)
        made, place = grow_templates([t.split("\x1f") for t in group["template"]])
        final = ["\x1f".join(t) for t in made]
        out = group[["leaf", "template", "lines"]].assign(final=[final[p] for p in place])
        return out.assign(done=group["chunk"] == "0")

    schema = "leaf long, template string, lines long, final string, done boolean"
    number, idle, before, finals = 0, 0, None, None
    while True:
        step = dealt_templates(kinds, number).groupBy("leaf", "chunk").applyInPandas(merged, schema)
        step = stage(step, "merged")
        if finals is None:
            finals = step.select("leaf", "template", "final", "done")
        else:
            then = step.select("leaf", F.col("template").alias("final"), F.col("final").alias("then"), F.col("done").alias("now"))
            finals = finals.join(then, ["leaf", "final"], "left").select(
                "leaf", "template", F.coalesce("then", "final").alias("final"), F.coalesce("now", "done").alias("done")
            )
            finals = stage(finals, "finals")
        rest = step.where("NOT done").groupBy("leaf", F.col("final").alias("template")).agg(F.sum("lines").alias("lines"))
        kinds = stage(rest, "kinds")
        left = kinds.count()
        idle = idle + 1 if left == before else 0
        if left == 0 or idle == IDLE_ROUNDS:
            return finals.select("leaf", "template", "final")
        number, before = number + 1, left


def recurring_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """(copy, line) of the lines by text whose template is in ``min_docs`` texts or more.

    Tasks send hashes of lines and leaves first. Tokens are sent only for lines in leaves that
    ``min_docs`` different texts reach, once per task and line. A leaf's lines are made into templates in
    chunks of about CHUNK_LINES, and the chunks' templates into the leaf's by ``merge_templates``.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            copies, leaves, hashes = [], [], []
            for copy, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = line_keys(text)
                copies += [copy] * len(found)
                leaves += found.values()
                hashes += found
            columns = [pa.array(c, pa.int64()) for c in (copies, leaves, hashes)]
            yield pa.RecordBatch.from_arrays(columns, names=["copy", "leaf", "line"])

    texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("copy"), "text")
    # copies of a text count once
    lines = stage(texts.mapInArrow(keys, "copy long, leaf long, line long").distinct(), "lines")
    # counted by line before anything is dealt by leaf, so that a common line is one row there
    counted = stage(lines.groupBy("leaf", "line").agg(F.count("*").alias("texts")), "counted")
    leaves = counted.groupBy("leaf").agg(F.sum("texts").alias("reached"), F.count("*").alias("different"))
    leaves = leaves.where(F.col("reached") >= min_docs)
    leaves = leaves.select("leaf", F.ceil(F.col("different") / CHUNK_LINES).alias("chunks"))
    sizes = stage(counted.join(leaves, "leaf"), "sizes")

    # tokens are read again, of the lines asked for only
    low_bits = F.col("line").bitwiseAND(F.lit(FILTER_BITS - 1))
    asked = docs.sparkSession.sparkContext.broadcast(bitmap_of(sizes, "line", low_bits))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: dict[int, str] = {}
            for text in batch.column(0).to_pylist():
                for line in dict.fromkeys(text.split("\n")):
                    words = line_tokens(line)
                    if words:
                        joined = "\x1f".join(words)
                        found[_hash(joined)] = joined
            hashes = np.fromiter(found, np.int64, len(found))
            hit = np.flatnonzero(in_bitmap(asked.value, hashes & (FILTER_BITS - 1)))
            joined = list(found.values())
            columns = [pa.array(hashes[hit]), pa.array([joined[k] for k in hit], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["line", "tokens"])

    every = texts.select("text").mapInArrow(tokens, "line long, tokens string")
    words = every.groupBy("line").agg(F.min("tokens").alias("tokens"))
    known = sizes.join(words, "line")
    known = known.withColumn("chunk", F.pmod(F.xxhash64("line"), "chunks")).select("leaf", "chunk", "line", "tokens", "texts")

    def templates(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["texts", "line"], ascending=[False, True], ignore_index=True)
        made, place = grow_templates([t.split("\x1f") for t in group["tokens"]])
        joined = ["\x1f".join(t) for t in made]
        return group[["leaf", "line", "texts"]].assign(template=[joined[p] for p in place])

    schema = "leaf long, line long, texts long, template string"
    placed = stage(known.groupBy("leaf", "chunk").applyInPandas(templates, schema), "templates")

    kinds = stage(placed.groupBy("leaf", "template").agg(F.count("*").alias("lines")), "kinds")
    finals = merge_templates(kinds)
    fields = F.split("final", "\x1f")
    constant = F.size(F.filter(fields, lambda t: t != VARIABLE))
    finals = finals.where(constant >= F.size(fields) * LEAST_CONSTANT)
    named = F.xxhash64("leaf", "final").alias("template")
    placed = stage(placed.join(finals, ["leaf", "template"]).select("line", "texts", named), "templates")
    total = lines.count()
    of_lines = attach_groups(lines.select("copy", "line"), placed, ["line"], "texts", total)
    of_lines = stage(of_lines.where("template IS NOT NULL").select("copy", "line", "template"), "placed")
    in_texts = of_lines.groupBy("template", "copy").agg(F.count("*").alias("lines"))
    recurs = in_texts.groupBy("template").agg(F.count("*").alias("texts"), F.sum("lines").alias("rows"))
    recurs = stage(recurs.where(F.col("texts") >= min_docs).select("template", "rows"), "recurs")
    found = attach_groups(of_lines, recurs, ["template"], "rows", total)
    return found.where("rows IS NOT NULL").select("copy", "line")


def drop_recurring_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` with recurring lines dropped from text, and n_lines and n_dropped added.

    Lines are parsed as log lines are: a tree of fixed depth leads, by the number of
    tokens and the LEADING_TOKENS first of them, to a leaf, and in a leaf lines that agree in
    SIMILAR of their tokens share a template; tokens with digits are variable from the start. Of a template's tokens LEAST_CONSTANT
    must not be variable. Of a leaf with more than CHUNK_LINES different lines, which templates meet depends on how its lines are
    dealt, so such a leaf is approximate. A line goes
    if its template is in ``min_docs`` different texts or more; equal texts count once, so copies
    of a document alone drop nothing.

    Null texts stay null, with 0 lines. Empty lines stay. A text may become empty. Repeated
    rows are treated alike. An empty table gives no rows; other columns stay, save those named
    n_lines or n_dropped, which are replaced.
    """
    dropped = recurring_lines(docs, min_docs).groupBy("copy").agg(F.collect_set("line").alias("drop"))
    # the caller's columns travel as one, so that no name of theirs meets one of these
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"_{n}") for n, c in enumerate(others))).alias("row"),
        "text",
        F.xxhash64("text").alias("copy"),
    )
    sizes = rows.groupBy("copy").agg(F.count("*").alias("rows"))
    groups = stage(sizes.join(dropped, "copy"), "dropped")

    # only texts that lose a line are joined; by merging, so that the plan is the same at every size
    losing = docs.sparkSession.sparkContext.broadcast(bitmap_of(groups, "copy"))

    def probable_loss(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bits in parts:
            yield pd.Series(in_bitmap(losing.value, bits.to_numpy()))

    rows = rows.withColumn("loses", F.pandas_udf(probable_loss, "boolean")(filter_bit("copy")))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    whole = rows.where("NOT loses").select(
        "row", "text", F.coalesce(lines, F.lit(0)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")
    )
    found = attach_groups(stage(rows.where("loses").drop("loses"), "losing"), groups, ["copy"], "rows", docs.count(), "merge")
    found = found.select("row", "text", "drop")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, before, gone = [], [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                every = text.split("\n")
                asked = set(drop or ())
                kept = [x for x in every if not asked or _hash("\x1f".join(line_tokens(x))) not in asked]
                texts.append("\n".join(kept))
                before.append(len(every))
                gone.append(len(every) - len(kept))
            columns = [pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", "text", "n_lines", "n_dropped"])

    cleaned = found.mapInArrow(clean, whole.schema)
    names = [
        "text" if c == "text" else F.col(f"row._{others.index(c)}").alias(c)
        for c in docs.columns
        if c not in ("n_lines", "n_dropped")
    ]
    return cleaned.unionByName(whole).select(*names, "n_lines", "n_dropped")
