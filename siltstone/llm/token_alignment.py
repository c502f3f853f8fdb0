"""Aligning the tokens that two tokenizers make of the same texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.packing import Encoder, _byte_ranks, default_tokenizer
from siltstone.llm.shingles import slices
from siltstone.sinks.staging import stage

# Texts are aligned in batches of about so many characters; a longer one is a batch of its own.
BATCH_CHARS = 1 << 19

_SPACE_MARK = "▁"


def default_piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ByteSide(Encoder):
    """A byte-level BPE over space and text; strings of special tokens are plain text."""

    def __init__(self, definition: str):
        import json

        super().__init__(definition)
        self._tokenizer.encode_special_tokens = True
        ranks = _byte_ranks(json.loads(definition))
        if ranks is None or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("not a plain byte-level BPE")
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for word, n in ranks.items():
            self.bytes_of[n] = word

    def _ordinary(self, text: str) -> bool:
        # without special tokens there is nothing in "<|" for the library alone
        return super()._ordinary(text.replace("<|", "<"))

    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """Nothing is normalized and every byte is a token, so the bytes are always those of space and text."""
        return [self.encode(" " + t).astype(np.int64) for t in texts]


class PieceSide:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_of = [self._bytes(n) for n in range(self._model.get_piece_size())]

    def _bytes(self, n: int) -> bytes:
        piece = self._model.id_to_piece(n)
        if self._model.is_byte(n):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_SPACE_MARK, " ").encode()

    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """None where the pieces' bytes are not those of space and text."""
        found = []
        for text, ids in zip(texts, self._model.encode(list(texts), num_threads=1)):
            same = b"".join(map(self.bytes_of.__getitem__, ids)) == b" " + text.encode()
            found.append(np.array(ids, dtype=np.int64) if same else None)
        return found


@lru_cache(maxsize=2)
def _byte_side(definition: str) -> ByteSide:
    return ByteSide(definition)


@lru_cache(maxsize=2)
def _piece_side(model: bytes) -> PieceSide:
    return PieceSide(model)


def linkable_pairs(first: Sequence[bytes], second: Sequence[bytes]) -> np.ndarray:
    """All (first id, second id) as ``first * len(second) + second`` whose tokens can end together, sorted.

    Of two tokens of one text that end together the shorter is the end of the longer, so the
    vocabularies alone bound the pairs, whatever the corpus.
    """
    holders: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for side, held in zip((first, second), holders):
        for n, token in enumerate(side):
            if token:
                held.setdefault(token, []).append(n)
    keys = {
        a * len(second) + b
        for a, token in enumerate(first)
        for cut in range(len(token))
        for b in holders[1].get(token[cut:], ())
    }
    keys |= {
        a * len(second) + b
        for b, token in enumerate(second)
        for cut in range(1, len(token))
        for a in holders[0].get(token[cut:], ())
    }
    return np.array(sorted(keys), dtype=np.int64)


@dataclass
class Alignment:
    """Tokens of some documents in a row; arrays run over all their tokens.

    ``bounds_*`` say where each document's tokens begin, ``group_*`` give each token's group
    within the batch, ``overlap_*`` and ``link_*`` the tokens of each overlapping pair and of each pair that ends together.
    """

    ids_a: np.ndarray
    ids_b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    overlap_a: np.ndarray
    overlap_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    def link_bounds(self) -> np.ndarray:
        return np.searchsorted(self.link_a, self.bounds_a)


def _laid_out(ids: Sequence[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Ids in a row, where each document's begin, and a frame of document and first byte of every token."""
    flat = np.concatenate([np.zeros(0, np.int64), *ids])
    counts = [len(x) for x in ids]
    sizes = lengths[flat]
    start = np.cumsum(sizes) - sizes
    frame = pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), counts), "start": start, "token": np.arange(len(flat))})
    return flat, np.cumsum([0, *counts]), frame


def align_ids(
    ids_a: Sequence[np.ndarray], ids_b: Sequence[np.ndarray], lengths_a: np.ndarray, lengths_b: np.ndarray
) -> Alignment:
    """Align documents that have the same bytes on both sides; ``lengths_*`` give the bytes of every id.

    An as-of merge by document finds for the start of each token the other side's token that covers it, in
    both directions; two tokens overlap exactly if one covers the start of the other. Overlapping
    tokens with equal ends are links and close the groups.
    """
    flat_a, bounds_a, a = _laid_out(ids_a, lengths_a)
    flat_b, bounds_b, b = _laid_out(ids_b, lengths_b)
    end_a = a["start"].to_numpy() + lengths_a[flat_a]
    end_b = b["start"].to_numpy() + lengths_b[flat_b]
    # bytes are numbered through the batch, so both frames are in order of start
    over_a = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    over_b = pd.merge_asof(b, a, on="start", by="doc", suffixes=("_b", "_a"), allow_exact_matches=False).dropna()
    overlap_a = np.concatenate([over_a["token_a"], over_b["token_a"].astype(np.int64)])
    overlap_b = np.concatenate([over_a["token_b"], over_b["token_b"].astype(np.int64)])
    # the token before may end where this one starts
    meet = np.minimum(end_a[overlap_a], end_b[overlap_b]) > np.maximum(
        a["start"].to_numpy()[overlap_a], b["start"].to_numpy()[overlap_b]
    )
    overlap_a, overlap_b = overlap_a[meet], overlap_b[meet]
    together = end_a[overlap_a] == end_b[overlap_b]
    link_a, link_b = np.sort(overlap_a[together]), np.sort(overlap_b[together])
    ends = end_a[link_a]
    return Alignment(
        flat_a, flat_b, bounds_a, bounds_b, np.searchsorted(ends, end_a), np.searchsorted(ends, end_b),
        overlap_a, overlap_b, link_a, link_b,
    )


@lru_cache(maxsize=2)
def _digits(vocabulary: int) -> np.ndarray:
    """Bytes of every id in decimal with each of the four things that may follow it, zeros behind."""
    width = len(str(vocabulary)) + 1
    return np.array(
        [[str(n) + after for n in range(vocabulary)] for after in (",", "|", ";", "")], dtype=f"S{width}"
    ).view(np.uint8).reshape(4, vocabulary, width)


def _followed(group: np.ndarray, closing: int) -> np.ndarray:
    """0 behind a token whose group goes on, else ``closing``."""
    last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
    return np.where(last, closing, 0)


def group_hashes(found: Alignment, digits: np.ndarray) -> list[str]:
    """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    na, nb = len(found.ids_a), len(found.ids_b)
    at_a = np.arange(na) + np.searchsorted(found.group_b, found.group_a)
    at_b = np.arange(nb) + np.searchsorted(found.group_a, found.group_b, "right")
    ids = np.empty(na + nb, np.int64)
    after = np.empty(na + nb, np.int64)
    ids[at_a], ids[at_b] = found.ids_a, found.ids_b
    after[at_a], after[at_b] = _followed(found.group_a, 1), _followed(found.group_b, 2)
    bounds = found.bounds_a + found.bounds_b
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    after[ends] = 3
    shown = digits[after, ids]
    filled = shown != 0
    text = shown[filled].tobytes()
    places = np.append(0, np.cumsum(filled.sum(axis=1)))[bounds]
    return [hashlib.sha256(text[i:j]).hexdigest() if j > i else "" for i, j in zip(places[:-1], places[1:])]


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of about BATCH_CHARS; a long text does not wait for others."""
    ids: list[int | None] = []
    texts: list[str] = []
    held = 0
    for part in parts:
        for at in range(0, part.num_rows, 256):
            few = part.slice(at, 256)
            for doc_id, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                if ids and held + len(text) > BATCH_CHARS:
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
    if ids:
        yield ids, texts


class _Aligner:
    """Both sides in a task."""

    def __init__(self, definition: str, model: bytes):
        self.sides = _byte_side(definition), _piece_side(model)
        self.lengths = [np.array([len(w) for w in side.bytes_of], np.int64) for side in self.sides]

    def align(self, texts: Sequence[str]) -> Alignment:
        """Texts that either side does not give back byte for byte have no tokens."""
        a, b = (side.encode_all(texts) for side in self.sides)
        none = np.zeros(0, np.int64)
        for n, text in enumerate(texts):
            if not text or a[n] is None or b[n] is None:
                a[n], b[n] = none, none
        return align_ids(a, b, *self.lengths)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def _numbers(column: pa.Array) -> np.ndarray:
    """What all rows of a binary column hold, as four-byte numbers in a row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4")


def _sources(docs: DataFrame, tokenizer: str | None, piece_model: str | None):
    """(doc_id, text) rows, and both vocabularies as broadcasts: files of fixed size."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        definition = file.read()
    with open(piece_model or default_piece_model(), "rb") as file:
        model = file.read()
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows, context.broadcast((definition, model))


def align_tokens(docs: DataFrame, tokenizer: str | None = None, piece_model: str | None = None) -> DataFrame:
    """Tokens of both sides of every document, their groups and all overlapping pairs.

    ``docs`` has doc_id (integer) and text; other columns are ignored. Side a is the byte-level BPE
    ``tokenizer`` over a space and the text, side b the sentencepiece model ``piece_model`` over the text.
    Returns doc_id; a_ids and b_ids; a_groups and b_groups, the number of each token's group in its
    document; overlap_a and overlap_b, the places of the tokens of each overlapping pair, in order.

    A text that is null or empty, or that either side's bytes don't give back (as for U+2581), has no
    tokens. A null doc_id stays null, repeated rows are documents of their own, an empty table
    gives no rows. Nothing is shuffled; a task holds BATCH_CHARS characters, or one longer text.
    """
    rows, files = _sources(docs, tokenizer, piece_model)
    names = ["a_ids", "b_ids", "a_groups", "b_groups", "overlap_a", "overlap_b"]

    def align(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(*files.value)
        for ids, texts in _batches(parts):
            x = aligner.align(texts)
            first = np.repeat(x.link_bounds()[:-1], np.diff(x.bounds_a)), np.repeat(x.link_bounds()[:-1], np.diff(x.bounds_b))
            order = np.lexsort((x.overlap_b, x.overlap_a))
            over_a, over_b = x.overlap_a[order], x.overlap_b[order]
            over = np.searchsorted(over_a, x.bounds_a)
            times = np.diff(over)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    _lists(x.ids_a, x.bounds_a),
                    _lists(x.ids_b, x.bounds_b),
                    _lists(x.group_a - first[0], x.bounds_a),
                    _lists(x.group_b - first[1], x.bounds_b),
                    _lists(over_a - np.repeat(x.bounds_a[:-1], times), over),
                    _lists(over_b - np.repeat(x.bounds_b[:-1], times), over),
                ],
                names=["doc_id", *names],
            )

    return rows.mapInArrow(align, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def alignment_summary(docs: DataFrame, tokenizer: str | None = None, piece_model: str | None = None) -> DataFrame:
    """Per document the size of its alignment, its groups as a hash, and how usual its links are in the corpus.

    Input, odd rows and method are those of ``align_tokens``. Returns doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum (longs) and groups_sha256. The count of a pair of ids is the number of links of the
    corpus that hold it; n_best are the links whose count is the highest of their b id, ties included.

    Documents are encoded once and written with the numbers of their links' pairs, four bytes each. Counts are made
    in every task and then summed. The vocabularies bound the pairs (``linkable_pairs``: some
    hundred thousand), so all counts go to the driver and back as one array.
    """
    rows, files = _sources(docs, tokenizer, piece_model)
    context = docs.sparkSession.sparkContext
    definition, model = files.value
    first, second = _byte_side(definition).bytes_of, _piece_side(model).bytes_of
    pairs = linkable_pairs(first, second)
    known, wide = context.broadcast(pairs), len(second)
    size = len(pairs)

    def describe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(*files.value)
        digits = _digits(max(len(side.bytes_of) for side in aligner.sides))
        for ids, texts in _batches(parts):
            x = aligner.align(texts)
            linked = np.searchsorted(known.value, x.ids_a[x.link_a] * wide + x.ids_b[x.link_b])
            links = x.link_bounds()
            counts = [np.diff(x.bounds_a), np.diff(x.bounds_b), np.diff(links), np.diff(links)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(group_hashes(x, digits), pa.string()),
                    pa.array([linked[i:j].astype("<i4").tobytes() for i, j in zip(links[:-1], links[1:])], pa.binary()),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
            )

    described = stage(
        rows.mapInArrow(
            describe,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary",
        ),
        "alignments",
    )

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in slices(parts, 1024):
            total += np.bincount(_numbers(part.column(0)), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["pair", "links"])

    counted = described.select("pairs").mapInArrow(count, "pair long, links long")
    summed = counted.groupBy("pair").agg(F.sum("links").alias("links")).toPandas()
    times = np.zeros(size, np.int64)
    times[summed["pair"].to_numpy(np.int64)] = summed["links"].to_numpy(np.int64)
    most = np.zeros(wide, np.int64)
    np.maximum.at(most, pairs % wide, times)
    shared = context.broadcast((times, times == most[pairs % wide]))

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for part in slices(parts, 1024):
            at = _numbers(part.column("pairs"))
            ends = np.cumsum(part.column("n_links").to_numpy())
            sums = [np.append(0, np.cumsum(values[at], dtype=np.int64)) for values in (best, counts)]
            n_best, count_sum = (s[ends] - s[np.append(0, ends[:-1])] for s in sums)
            columns = {c: part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
            columns |= {"groups_sha256": part.column("groups_sha256")}
            yield pa.RecordBatch.from_pydict(columns)

    return described.mapInArrow(
        weigh,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
