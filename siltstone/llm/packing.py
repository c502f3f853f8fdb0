"""Packing token sequences into windows of equal capacity."""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

# How byte-level vocabularies of this kind split text, the byte alphabet of their entries, and
# the Latin-1 characters that regex engines class differently. Fixed values.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_UNUSUAL = b"\x1c\x1d\x1e\x1f\x85\xb2\xb3\xb9\xbc\xbd\xbe"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_ranks(kind: dict) -> dict[bytes, int] | None:
    """Byte strings and ids of a plain byte-level BPE, or None if it is anything else."""
    before, model = kind.get("pre_tokenizer") or {}, kind["model"]
    plain = (
        kind.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and model.get("type", "BPE") == "BPE"
    )
    if not plain:
        return None
    shown = {chr(b): b for b in _SHOWN}
    hidden = (b for b in range(256) if b not in set(_SHOWN))
    shown |= {chr(256 + n): b for n, b in enumerate(hidden)}
    special = {t["content"] for t in kind.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get("".join(m), -1) for m in merges]
    if any(a >= b for a, b in zip(made, made[1:])):  # ids must be the merges' order
        return None
    return {bytes(shown[c] for c in word): n for word, n in model["vocab"].items() if word not in special}


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them.

    Latin-1 text goes through ``tiktoken`` with the same vocabulary, which is several times
    faster and gives the same ids (tested). Any other text, and any that may hold a special
    token, goes to the library itself.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        ranks = _byte_ranks(json.loads(definition))
        self._fast = None
        if ranks is not None:
            import tiktoken

            self._fast = tiktoken.Encoding(
                "corpus", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}
            )

    def _ordinary(self, text: str) -> bool:
        if self._fast is None or "<|" in text:
            return False
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return len(plain) == len(plain.translate(None, _UNUSUAL))

    def encode(self, text: str) -> np.ndarray:
        if self._ordinary(text):
            return np.array(self._fast.encode_ordinary(text), dtype="<u4")
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    """One per worker process, which serves many tasks."""
    return Encoder(definition)


def difference_partitions(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp differencing: indices of ``sizes`` in ``windows`` sets of nearly equal sums.

    Every size starts as a partial partition with one filled set. The two partial
    partitions of the largest imbalance are merged again and again, the fullest
    set of one with the emptiest of the other, so that imbalances cancel.
    """
    # (-imbalance, number, sets that hold anything as (sum, members), fullest first)
    heap = [(-size, n, [(size, (n,))]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        alone_one, alone_two = max(0, windows - len(two)), max(0, windows - len(one))
        met = [
            (a[0] + b[0], (a[1], b[1]))
            for a, b in zip(one[alone_one:], reversed(two[alone_two:]))
        ]
        merged = sorted(one[:alone_one] + two[:alone_two] + met, key=lambda s: -s[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], number, merged))
        number += 1
    sets = [_flat(members) for _, members in heap[0][2]] if heap else []
    return sets + [[] for _ in range(windows - len(sets))]


def _flat(members) -> list[int]:
    out, todo = [], [members]
    while todo:
        for m in todo.pop():
            if isinstance(m, tuple):
                todo.append(m)
            else:
                out.append(m)
    return sorted(out)


def pack_pieces(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Sets of pieces of at most ``capacity`` tokens; one window more whenever a set is too full."""
    if not lengths:
        return []
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        sets = difference_partitions(lengths, windows)
        if max(sum(lengths[i] for i in s) for s in sets) <= capacity:
            return [s for s in sets if s]
        windows += 1


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = 2048,
    longest_piece: int = 512,
    halved_every: int = 4,
    finest: int = 16,
    windows_per_group: int = 64,
    spare_per_window: int = 8,
    end_id: int = 1,
) -> DataFrame:
    """Cut all documents into pieces and pack them into sequences of at most ``capacity`` tokens.

    ``docs`` has doc_id (integer) and text; other columns are ignored. Returns
    PIECE_COLUMNS, one row per piece. A document's ids are those of its text plus
    ``end_id``. Whole windows are cut off a document first; what is left is cut into
    pieces of at most ``longest_piece``, and the end of every ``halved_every``-th document is
    halved down to ``finest`` tokens, as small pieces are what evens out sums. Karmarkar-Karp
    differencing spreads the pieces over windows, a group of ``windows_per_group`` at a time.
    A group is closed, cutting its last piece, when it holds all but ``spare_per_window``
    tokens a window, which is the padding then. The last group of a task fills as many
    windows as its tokens need.

    Tasks work on their own rows only: nothing is shuffled, a task holds one group and one
    Arrow batch, and one that runs again over a file scan cuts and numbers alike. After a shuffle
    the order of rows in a task may change, so write such input first. ``sequence_id`` has the
    task's number in its high bits.

    Nulls and empty texts: the document is its ``end_id`` alone. A null doc_id stays null.
    Repeated rows are documents of their own. An empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: fixed size
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("task")
    )
    closed_at = windows_per_group * capacity - windows_per_group * spare_per_window
    names = [c.split()[0] for c in PIECE_COLUMNS.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        out: list[tuple] = []
        pool: list[tuple] = []
        held, serial, rests = 0, 0, 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        def flush() -> None:
            nonlocal held, serial
            for members in pack_pieces([length for _, _, length, _, _ in pool], capacity):
                offset = 0
                for i in members:
                    out.append((*pool[i], serial, offset))
                    offset += pool[i][2]
                serial += 1
            pool.clear()
            held = 0

        for part in batches:
            task = part.column(2)[0].as_py() if part.num_rows else 0
            serial = max(serial, task << 40)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = np.append(encoder.encode(text), np.uint32(end_id))
                total, start = len(ids), 0
                rests += 1
                while start < total:
                    left = total - start
                    if left >= capacity:
                        length = capacity
                    else:
                        length = min(left, longest_piece)
                        if left <= longest_piece and left > finest and rests % halved_every == 0:
                            length = -(-left // 2)
                        length = min(length, closed_at - held)
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    piece = (doc_id, start, length, crc, total)
                    start += length
                    if length == capacity:
                        out.append((*piece, serial, 0))
                        serial += 1
                        continue
                    pool.append(piece)
                    held += length
                    if held == closed_at:
                        flush()
                if len(out) > 50_000:
                    yield batch()
        flush()
        if out:
            yield batch()

    return rows.mapInArrow(pack, PIECE_COLUMNS)
