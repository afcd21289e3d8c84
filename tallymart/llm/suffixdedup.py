"""Remove bytes covered by a 100-byte string that starts earlier in the corpus.

Candidates come from ``spans``: a window's anchor is the smallest of the hashes of its 24-byte grams, the
leftmost if equal. Contexts of an anchor line up at it, so two windows are equal if what follows the anchor
agrees, and what precedes it, read backwards. Both sides are suffixes, and both are sorted by a mergesort
whose comparisons find the common extension by binary search over prefix polynomial hashes; every
neighbouring extension is then checked byte by byte, and a group in which a hash lied is sorted by its
bytes. In the sorted orders, sides that agree for a given length are neighbours.

Earlier means a smaller doc_id, or the same document and an earlier start.

Edge cases: a null text is empty. Of equal texts of 100 bytes and more, all but the one with the smallest
id lose everything. A null id comes after all others. Documents that repeat an id with different texts are
ordered by a hash of the text; repeated rows (same id and text) are one document, and each gets its
result. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .flat import byte_values, chunks, inverse_powers, places, prefix_sums, scramble, span_hash
from .spans import batch_of, by_text, classes, compared, consecutive, forget, mask, of_documents, runs, unique_texts

WINDOW = 100
GRAM = 24
_GRAMS = WINDOW - GRAM + 1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    low, size = values, 1
    while 2 * size <= width:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    rest = width - size
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def find_runs(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Runs of windows with one anchor, chunk by chunk."""
    for row, data, offsets in chunks(batch, "text"):
        n = len(data) - WINDOW + 1
        if n < 1:
            continue
        sums = prefix_sums(byte_values(data))
        count = len(data) - GRAM + 1
        hashes = scramble((sums[GRAM:] - sums[:-GRAM]) * inverse_powers(count))
        bits = np.uint64(max(20, int(count).bit_length()))
        best = sliding_min((hashes >> bits << bits) | np.arange(count, dtype=np.uint64), _GRAMS)
        place = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        whole = np.repeat(offsets[1:], np.diff(offsets))[:n] - np.arange(n) >= WINDOW
        before = np.concatenate([[False], whole[:-1]])
        moved = np.concatenate([[True], place[1:] != place[:-1]])
        new = whole & (moved | ~before)
        first = np.flatnonzero(new)
        edges = np.append(np.flatnonzero(new | (before & ~whole)), n)
        length = edges[np.searchsorted(edges, first, "right")] - first
        off = place[first] - first
        context = scramble(span_hash(sums, first, first + length + (WINDOW - 1)) + scramble((length * 128 + off).astype(np.uint64)))
        rows = np.searchsorted(offsets, first, "right") - 1
        yield row, rows, hashes[place[first]], context, first - offsets[rows], length, off


def fetch_contexts(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The bytes that each run's windows cover."""
    texts = batch.column("text")
    at, data = places(texts)
    sizes = length.astype(np.int64) + (WINDOW - 1)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(offsets[-1]) + np.repeat(at[row] + start - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[index])])


class Suffixes:
    """Suffixes of a flat byte array, compared by prefix polynomial hashes up to their limits."""

    def __init__(self, data: np.ndarray, start: np.ndarray, limit: np.ndarray):
        self.data, self.start, self.limit = np.append(data, np.uint8(0)), start, limit
        self.sums = prefix_sums(byte_values(data))
        self.inverse = inverse_powers(len(data) + 1)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common length of each pair of suffixes, by binary search."""
        a, b = self.start[x], self.start[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.limit[x], self.limit[y])
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            equal = (self.sums[a + mid] - self.sums[a]) * self.inverse[a] == (self.sums[b + mid] - self.sums[b]) * self.inverse[b]
            low, high = np.where(equal, mid, low), np.where(equal, high, np.maximum(mid - 1, low))
        return low

    def before(self, x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether x sorts before y; of equal ones, ``ties`` decides."""
        common = self.extension(x, y)
        ends_x, ends_y = common >= self.limit[x], common >= self.limit[y]
        a, b = self.data[self.start[x] + common * ~ends_x], self.data[self.start[y] + common * ~ends_y]
        return np.where(ends_x & ends_y, ties, np.where(ends_x, True, np.where(ends_y, False, a < b)))

    def order(self, group: np.ndarray) -> np.ndarray:
        """Mergesort inside each group: all merges of a level at once, ranks by binary search."""
        order = np.argsort(group, kind="stable")
        sizes = np.unique(group, return_counts=True)[1]
        base = np.repeat(np.cumsum(sizes) - sizes, sizes)
        total = np.repeat(sizes, sizes)
        place = np.arange(len(order)) - base
        width = 1
        while width < sizes.max(initial=0):
            run = place // width
            low = (run ^ 1) * width
            high = np.minimum(low + width, total)
            active = np.flatnonzero(low < total)
            x, ties = order[active], (run[active] & 1) == 0
            lo, hi = (base + low)[active], (base + high)[active]
            first = lo.copy()
            for _ in range(int(width).bit_length()):
                open_ = lo < hi
                mid = (lo + hi) >> 1
                y = order[np.where(open_, mid, 0)]
                sibling_first = ~self.before(x, y, ties)
                lo = np.where(open_ & sibling_first, mid + 1, lo)
                hi = np.where(open_ & ~sibling_first, mid, hi)
            merged = np.arange(len(order))
            merged[active] = (base + (run // 2) * 2 * width + place % width)[active] + lo - first
            fresh = np.empty_like(order)
            fresh[merged] = order
            order, width = fresh, 2 * width
        return order

    def sorted(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, extension of each with its predecessor; -1 at a group's start), verified byte by byte."""
        order = self.order(group)
        common = self.extension(order[1:], order[:-1])
        if not self._true(order, common, group):
            texts = [self.data[s:s + n].tobytes() for s, n in zip(self.start, self.limit)]
            order = np.array(sorted(range(len(texts)), key=lambda i: (group[i], texts[i])))
            common = np.array([_common(texts[i], texts[j]) for i, j in zip(order[1:], order[:-1])], np.int64)
        common[group[order[1:]] != group[order[:-1]]] = -1
        return order, np.concatenate([[-1], common])

    def _true(self, order: np.ndarray, common: np.ndarray, group: np.ndarray) -> bool:
        """Whether neighbours agree for exactly ``common`` bytes and stand in order."""
        x, y = order[:-1], order[1:]
        offsets = np.concatenate([[0], np.cumsum(common)])
        step = np.arange(offsets[-1]) - np.repeat(offsets[:-1], common)
        if not np.array_equal(self.data[step + np.repeat(self.start[x], common)], self.data[step + np.repeat(self.start[y], common)]):
            return False
        ends_x, ends_y = common >= self.limit[x], common >= self.limit[y]
        a, b = self.data[self.start[x] + common * ~ends_x], self.data[self.start[y] + common * ~ends_y]
        return bool(np.all((group[x] != group[y]) | ends_x | (~ends_y & (a < b))))


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def match_windows(batch: pa.RecordBatch, length: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the contexts that an earlier context has too, as (row, first window, number)."""
    at, data = places(batch.column("content"))
    data = data[at[0]:at[-1]]
    at = at - at[0]
    group = np.unique(batch.column("anchor").to_numpy(), return_inverse=True)[1]
    off = off.astype(np.int64)
    after = Suffixes(data, at[:-1] + off, np.diff(at) - off).sorted(group)
    ahead = Suffixes(data[::-1], len(data) - (at[:-1] + off), off).sorted(group)
    rank = np.empty(len(off), np.int64)
    rank[np.lexsort((batch.column("start").to_numpy() + off, batch.column("text_hash").to_numpy(), batch.column("doc_id").to_numpy(),
                     batch.column("no_id").to_numpy(zero_copy_only=False)))] = np.arange(len(off))
    rows, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    of_after, of_ahead = np.empty(len(off), np.int64), np.empty(len(off), np.int64)
    for left in range(int(off.max(initial=-1)) + 1):
        has = np.flatnonzero((off >= left) & (off - length < left))
        of_after[after[0]] = np.cumsum(after[1] < WINDOW - left)
        of_ahead[ahead[0]] = np.cumsum(ahead[1] < left)
        key = of_after[has] * (len(off) + 1) + of_ahead[has]
        order = np.lexsort((rank[has], key))
        again = np.zeros(len(has), bool)
        again[1:] = key[order][1:] == key[order][:-1]
        hit = has[order[again]]
        rows.append(hit)
        windows.append(off[hit] - left)
    return consecutive(np.concatenate(rows), np.concatenate(windows))


_RESULT = "doc_id long, text_hash long, n_removed long, n_spans long, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, spans, sha = [], [], []
        for row, text in enumerate(batch.column("text")):
            body = text.as_py().encode()
            gone = mask(batch, row, len(body))
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0]))
            sha.append(hashlib.sha256(np.frombuffer(body, np.uint8)[~gone].tobytes() if removed[-1] else body).hexdigest())
        yield batch_of([part.split()[0] for part in _RESULT.split(", ")], [
            batch.column("doc_id"), batch.column("text_hash"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()),
        ])


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, text_hash, copies, text, spans): the (start, end) byte spans to remove of each different text."""
    texts, name = unique_texts(docs)
    marks = stored(classes(runs(texts, find_runs, everywhere=False), everywhere=False), "marks")
    return by_text(texts, marks, compared(texts, marks, fetch_contexts, match_windows), WINDOW), name


def digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the hash of the bytes that stay."""
    found, name = repeated_spans(docs)
    results = stored(found.mapInArrow(_kept, _RESULT), "kept")
    forget(docs.sparkSession, name)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("whole"),
    )
    long = F.col("n_bytes") >= WINDOW
    return of_documents(rows, results).select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.when(long, F.col("n_bytes")).otherwise(0)).alias("n_removed"),
        F.coalesce("n_spans", F.when(long, 1).otherwise(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", F.when(long, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("whole"))).alias("kept_sha256"),
    )
