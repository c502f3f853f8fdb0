"""Packing whole documents into as few windows as possible, by best fit and swap-based local search."""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shingles import slices
from siltstone.sinks.staging import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
WINDOWS = f"{PIECES}, sequence_id long, offset long"

# Words whose ids a task remembers, and characters of texts that it encodes at a time (or one longer text).
KNOWN_WORDS = 550_000
BATCH_CHARS = 1 << 20

# How vocabularies of this kind prepare and split text. Fixed values.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]

# The same split for lower-case Latin-1 text, and the characters that engines class differently.
_LETTERS = "a-zªµº\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9²³¹¼½¾"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
_UNUSUAL = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _splits_words(kind: dict) -> bool:
    """Whether the definition is lower-casing BPE over the words of ``_SPLIT``."""
    prepared = [
        (n.get("type"), (n.get("pattern") or {}).get("Regex")) for n in (kind.get("normalizer") or {}).get("normalizers", [])
    ]
    steps = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        prepared == _NORMALIZERS
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": _SPLIT}
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
        and all("<|" in t["content"] and not t.get("normalized") for t in kind.get("added_tokens", []))
    )


class WordEncoder:
    """Token ids of texts as the ``tokenizers`` library gives them.

    BPE never crosses a word, so Latin-1 text is split into words here and the library is asked once for
    each word not met before, for many in one call (same ids, tested): the token that ends a word tells
    them apart. Any other text, and any that may hold a special token, goes to the library whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        kind = json.loads(definition)
        self._words: dict[str, bytes] | None = {} if _splits_words(kind) else None
        self._before: dict[str, bytes] = {}
        if self._words is not None:
            vocabulary = kind["model"]["vocab"]
            self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ends[[n for token, n in vocabulary.items() if token.endswith(kind["model"]["end_of_word_suffix"])]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, words: set[str]) -> None:
        """Words not met for long are forgotten: those that were not asked for while KNOWN_WORDS others were."""
        if len(self._words) > KNOWN_WORDS:
            self._words, self._before = {}, self._words
        known = self._words
        new = words.difference(known)
        again = new.intersection(self._before)
        known.update((w, self._before[w]) for w in again)
        new = list(new - again)
        ids = self._ids(" ".join(new))
        cuts = np.flatnonzero(self._ends[ids]) + 1
        if len(cuts) == len(new):
            raw = ids.tobytes()
            starts = [0, *(4 * cuts).tolist()]
            known.update((w, raw[i:j]) for w, i, j in zip(new, starts, starts[1:]))
        else:
            known.update((w, self._ids(w).tobytes()) for w in new)

    def _words_of(self, text: str) -> list[str] | None:
        if self._words is None or any(x in text for x in _UNUSUAL):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return _LATIN.findall(text.lower())

    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray]:
        split = [self._words_of(text) for text in texts]
        if self._words is not None:
            self._learn(set(chain.from_iterable(w for w in split if w)))
        return [
            self._ids(text) if words is None else np.frombuffer(b"".join(map(self._words.__getitem__, words)), "<u4")
            for text, words in zip(texts, split)
        ]


@lru_cache(maxsize=2)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def best_fit(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Best fit, largest first: each size goes to the fullest window that has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (space left, window), in order
    for n in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(room, (sizes[n], -1))
        if at == len(room):
            left, window = capacity, len(bins)
            bins.append([])
        else:
            left, window = room.pop(at)
        bins[window].append(n)
        if left > sizes[n]:
            bisect.insort(room, (left - sizes[n], window))
    return bins


class _Search:
    """Windows that are not full, and exchanges between them that raise the sum of squared fills.

    All exchanges are seen from the emptier window, the source: it gives a net number of tokens to a
    window that is at least as full and has room for them, which always raises that sum.
    """

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins = [set(b) for b in bins]
        self.fill = np.array([int(sizes[b].sum()) for b in bins], np.int64)
        self.window = np.empty(len(sizes), np.int64)
        for n, b in enumerate(bins):
            self.window[b] = n
        # pieces of full windows never take part; the others by size
        part = np.flatnonzero(self.fill[self.window] < capacity)
        self.open = part[np.argsort(sizes[part], kind="stable")]
        self.first = np.flatnonzero(np.diff(sizes[self.open], prepend=-1))

    def _put(self, piece: int, window: int) -> None:
        old = self.window[piece]
        self.bins[old].discard(piece)
        self.bins[window].add(piece)
        self.fill[old] -= self.sizes[piece]
        self.fill[window] += self.sizes[piece]
        self.window[piece] = window

    def _room(self, source: int) -> np.ndarray:
        """Space in the windows that may take tokens from the source; -1 in all others."""
        room = np.where(self.fill >= self.fill[source], self.capacity - self.fill, -1)
        room[source] = -1
        return room

    def _move(self, source: int, room: np.ndarray) -> bool:
        """The largest piece that has room elsewhere, to the window that it fills best."""
        pieces = [n for n in self.bins[source] if self.sizes[n] <= room.max()]
        if not pieces:
            return False
        piece = max(pieces, key=lambda n: (self.sizes[n], -n))
        fits = np.flatnonzero(room >= self.sizes[piece])
        self._put(piece, int(fits[room[fits].argmin()]))
        return True

    def _reach(self, room: np.ndarray) -> np.ndarray:
        """For every size, the most that can be given for a piece that is smaller: its size and the room beside it."""
        at = room[self.window[self.open]]
        sized = self.sizes[self.open][self.first]
        most = np.maximum.reduceat(at, self.first)
        reach = np.full(self.capacity + 2, -1, np.int64)
        reach[sized + 1] = np.where(most >= 0, sized + most, -1)
        return np.maximum.accumulate(reach)

    def _exchange(self, source: int, given: tuple[int, ...], room: np.ndarray) -> None:
        """``given`` against the smaller piece elsewhere whose window is left the least room."""
        size = int(self.sizes[list(given)].sum())
        space = room[self.window[self.open]]
        left = space - (size - self.sizes[self.open])
        fits = np.flatnonzero((self.sizes[self.open] < size) & (space >= 0) & (left >= 0))
        piece = int(self.open[fits[left[fits].argmin()]])
        target = int(self.window[piece])
        self._put(piece, source)
        for g in given:
            self._put(g, target)

    def _improve(self, source: int) -> bool:
        """One move or exchange that empties the source further; the largest pieces first."""
        room = self._room(source)
        if self._move(source, room):
            return True
        reach = self._reach(room)
        pieces = np.array(sorted(self.bins[source], key=lambda n: (-self.sizes[n], n)))
        sizes = self.sizes[pieces]
        ones = np.flatnonzero(reach[sizes] >= sizes)
        if len(ones):
            self._exchange(source, (int(pieces[ones[0]]),), room)
            return True
        # two of a size are enough to try every pair of sizes
        kept = np.array([k for k in range(len(sizes)) if k < 2 or sizes[k] != sizes[k - 2]], np.int64)
        one, two = np.triu_indices(len(kept), 1)
        pair = sizes[kept[one]] + sizes[kept[two]]
        pairs = np.flatnonzero(reach[pair] >= pair)
        if len(pairs):
            best = pairs[pair[pairs].argmax()]
            self._exchange(source, (int(pieces[kept[one[best]]]), int(pieces[kept[two[best]]])), room)
            return True
        return False

    def run(self) -> list[list[int]]:
        least = -(-int(self.sizes.sum()) // self.capacity)
        changed = len(self.open) > 0
        while changed and (self.fill > 0).sum() > least:
            changed = False
            sources = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            for source in sources[np.argsort(self.fill[sources], kind="stable")].tolist():
                while self.bins[source] and self._improve(source):
                    changed = True
                if (self.fill > 0).sum() <= least:
                    break
        return [sorted(b) for b in self.bins if b]


def pack_sizes(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Indices of ``sizes`` (at most ``capacity`` each) in as few sets as the search finds.

    Starts from best fit. Then documents are moved, or exchanged one for one and two for one, between
    underfull sets, the emptiest first, as long as that raises the sum of squared fills, which empties
    sets. It ends when the sizes need all sets that are left, or no exchange helps.
    """
    if not len(sizes):
        return []
    values = np.asarray(sizes, np.int64)
    return _Search(values, best_fit([int(s) for s in values], capacity), capacity).run()


def _encoded(encoder: WordEncoder, texts: Sequence[str]) -> Iterator[np.ndarray]:
    few: list[str] = []
    held = 0
    for text in texts:
        if few and held + len(text) > BATCH_CHARS:
            yield from encoder.encode_all(few)
            few, held = [], 0
        few.append(text)
        held += len(text)
    yield from encoder.encode_all(few)


def cut_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Documents as token pieces of at most ``capacity``: PIECES and serial, which numbers them.

    A document's ids are those of its text (null: empty) plus ``end_id``. Only longer ones are cut, into pieces of
    ``capacity``, of which the last may be shorter. Nothing is shuffled.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: fixed size
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("task")
    )
    schema = f"{PIECES}, serial long"
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, serial = _encoder(definition.value), 0
        for part in slices(parts):
            out: list[tuple] = []
            serial = max(serial, part.column(2)[0].as_py() << 40 if part.num_rows else 0)
            for doc_id, tokens in zip(part.column(0).to_pylist(), _encoded(encoder, part.column(1).to_pylist())):
                ids = np.append(tokens, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    held = ids[start : start + capacity]
                    out.append((doc_id, piece, start, len(held), zlib.crc32(held.tobytes()), serial))
                    serial += 1
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(cut, schema)


def pack_best_fit(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    group_pieces: int = 16_384,
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as the search finds.

    ``docs`` has doc_id (integer) and text; other columns are ignored. Returns WINDOWS, one row per piece
    (``cut_documents``). Pieces of ``capacity`` tokens are sequences of their own. The others are dealt
    by a hash of their numbers into groups of about ``group_pieces``, and each group is packed by
    ``pack_sizes``. So the fill depends on neither the number of files nor the order of rows, only a group's last
    sequence may lack documents to fill it, and no id, text or source makes a group large.

    Encoding shuffles nothing; 56 bytes a piece are written, read again to be counted and dealt, and shuffled
    once. Pieces are numbered in what was written, so a task that runs again gets the same groups.

    Nulls and empty texts: the document is its ``end_id`` alone. A null doc_id stays null. Repeated rows are
    documents of their own. An empty table gives no rows.
    """
    pieces = stage(cut_documents(docs, tokenizer, capacity, end_id), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("serial", ignore_index=True)
        sequence = np.empty(len(group), np.int64)
        offset = np.empty(len(group), np.int64)
        lengths = group["length"].to_numpy()
        for n, members in enumerate(pack_sizes(lengths, capacity)):
            sequence[members] = n
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        group["sequence_id"] = group["group"].to_numpy() * (1 << 32) + sequence
        group["offset"] = offset
        return group.drop(columns=["serial", "group"])

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("serial"), F.lit(groups)).cast("long"))
    packed = dealt.groupBy("group").applyInPandas(pack, WINDOWS)
    # groups count from 0, so their sequences do; those of whole windows lie below
    alone = whole.withColumn("sequence_id", -1 - F.col("serial")).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone.drop("serial"))
