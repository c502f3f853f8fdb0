"""Word shingles of whole texts as sorted sets of 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0xD6E8FEB86659FD93))

# A-Z only, and the white space that ends words. Fixed values.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]

_BATCH_BYTES = 1 << 18


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_FORTH = _powers(_STEP, 2 * _BATCH_BYTES)
_INVERSE = _powers(_BACK, 2 * _BATCH_BYTES)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX[2]
    return h ^ (h >> _U(29))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word; a word's hash is a polynomial in its bytes, from sums over all bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[::2], edges[1::2]
    forth, inverse = _FORTH, _INVERSE
    if len(raw) > len(forth):  # one very long text
        forth, inverse = _powers(_STEP, len(raw)), _powers(_BACK, len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * forth[: len(raw)])])
    return _mixed((sums[last] - sums[first]) * inverse[first]), first


def _sets(texts: Sequence[bytes], words: int) -> Iterator[np.ndarray]:
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    hashes, first = _word_hashes(b" ".join(texts))
    bounds = np.searchsorted(first, starts)
    runs = hashes[: max(0, len(hashes) - words + 1)].copy()
    for n in range(1, words):
        runs = (runs ^ (runs >> _U(31))) * _MIX[n % 2] + hashes[n : n + len(runs)]
    runs = _mixed(runs)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            short = _U(b - a)
            for h in hashes[a:b]:
                short = (short ^ (short >> _U(30))) * _MIX[0] + h
            yield _mixed(np.array([short], dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shingle_sets(texts: Sequence[str | None], words: int) -> Iterator[np.ndarray]:
    """The set of each text: its runs of ``words`` words, A-Z lower-cased.

    A text of fewer words is one run, a text without words the empty set. Texts are hashed
    in batches of about 256 KB.
    """
    with np.errstate(over="ignore"):
        batch: list[bytes] = []
        held = 0
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            if batch and held + len(data) + 1 > _BATCH_BYTES:
                yield from _sets(batch, words)
                batch, held = [], 0
            batch.append(data)
            held += len(data) + 1
        if batch:
            yield from _sets(batch, words)
