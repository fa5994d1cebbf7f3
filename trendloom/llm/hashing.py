"""Words and word shingles of whole texts as 64-bit hashes, vectorised over Arrow batches.

A word is a maximal run of bytes other than blank and 0x09-0x0D, A-Z in lower case. All
functions take the texts of a batch as one byte array with offsets; NULL counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLAB_BYTES = 4 << 20  # texts taken at once; one longer text is a slab of its own
# Texts hashed at once: some ten arrays of 8 bytes for each byte of text live at a time.
HASH_BYTES = 1 << 17

U = np.uint64
WORD_BASE = U(0x9E3779B97F4A7C15)
SHINGLE_BASE = U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that every bit depends on all bits."""
    x = x.astype(U, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U(shift)
        x *= U(factor)
    x ^= x >> U(31)
    return x


BYTES = np.arange(256)
SPACE = (BYTES == 0x20) | ((BYTES >= 0x09) & (BYTES <= 0x0D))
LOWERED = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)
CODE = mix(LOWERED.astype(U) + WORD_BASE)
EXACT_CODE = mix(BYTES.astype(U) + WORD_BASE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column of a batch."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), offsets


def slabs(data: np.ndarray, offsets: np.ndarray,
          limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts of at most ``limit`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield (first, last, data[offsets[first]:offsets[last]],
               offsets[first:last + 1] - offsets[first])
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray,
                code: np.ndarray = CODE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the words of each text in order."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    full = ~SPACE[data]
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = full[firsts]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, U), bounds
    at = np.arange(n) - np.repeat(np.concatenate(([0], starts)),
                                  np.diff(np.concatenate(([0], starts, [n]))))
    longest = int(at.max()) + 1
    powers = np.multiply.accumulate(np.concatenate(
        (np.ones(1, U), np.full(longest - 1, WORD_BASE, U))))
    values = code[data]
    values *= powers[at]
    values[~full] = U(0)
    return mix(np.add.reduceat(values, starts)), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray,
                   size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the shingles of ``size`` words of each text in order. A text of
    fewer words has its whole sequence as its only shingle; one without words has none."""
    lengths = np.diff(bounds)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    total = int(out_bounds[-1])
    if not total:
        return np.zeros(0, U), out_bounds
    at = np.arange(total) + np.repeat(bounds[:-1] - out_bounds[:-1], counts)
    span = np.repeat(np.minimum(lengths, size), counts)
    out, power = span.astype(U), U(1)
    padded = np.concatenate((words, np.zeros(size, U)))
    for j in range(size):
        power = U((int(power) * int(SHINGLE_BASE)) % (1 << 64))
        term = padded[at + j] * power
        if j:
            term[span <= j] = U(0)
        out += term
    return mix(out), out_bounds


def batch_shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes in text order) of every text of a batch column."""
    data, offsets = text_bytes(column)
    for first, last, part, inner in slabs(data, offsets, HASH_BYTES):
        hashes, bounds = shingle_hashes(*word_hashes(part, inner), size)
        for row in range(first, last):
            yield row, hashes[bounds[row - first]:bounds[row - first + 1]]
