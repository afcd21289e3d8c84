"""Texts of an Arrow batch as one flat byte array: words and hashes without a loop over documents.

Hashes of spans come from prefix sums of byte values times powers of an odd base, modulo 2^64, and are
scrambled at the end. Chunks keep the arrays small, whatever the batch size; a longer text is a chunk of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64; kept between calls up to a few chunks' length."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK_BYTES), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if len(known) <= 4 * CHUNK_BYTES:
            _powers[int(base)] = known
    return known[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(_INVERSE, n)


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: nearby inputs get unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) behind a column of texts or binary values without nulls, whichever width its offsets have."""
    kind = column.type
    if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        width = np.int64
    elif pa.types.is_string(kind) or pa.types.is_binary(kind):
        width = np.int32
    else:
        raise TypeError(f"texts or binary values are needed, not {kind}")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    return at, np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; a null text is empty."""
    texts = batch.column(column).fill_null("")
    at, data = places(texts)
    row = 0
    while row < len(texts):
        end = max(int(np.searchsorted(at, at[row] + limit, "right")) - 1, row + 1)
        yield row, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the total) of runs between white space."""
    inside = ~_IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """sums[j] - sums[i], times the inverse base to the i, depends on values[i:j] alone."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, not scrambled."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return (sums[ends] - sums[starts]) * powers(_INVERSE, int(starts.max()) + 1)[starts]


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = prefix_sums(byte_values(data))
    return scramble(span_hash(sums, starts, ends) + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every n consecutive values, documents' edges ignored."""
    count = max(len(hashes) - n + 1, 0)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total = total * _BASE + hashes[i:i + count]
    return scramble(total + np.uint64(salt))
