"""Remove words covered by a 35-word window that also occurs elsewhere in the corpus.

Texts are recompressed in rounds: runs of one symbol get a name, then pairs whose left and right
symbol fall on different sides of a coin get one. Names and coins are hashes of what they stand for, so
every task gives equal pairs equal names and the rounds need no exchange; a new coin is tossed for each
symbol in each round. A symbol remembers the stretch of words that decided it. Two equal windows
therefore hold the same symbols, apart from those that words outside had a say in, and of the
longest symbols that a window decides alone the one with the smallest hash is its anchor for ``spans``. A window that decides none is its own anchor.

No repeat rests on a hash. Runs whose contexts hash alike are held against each other word for word
(``spans.lied``); if any two differ, the rounds are run anew under another salt. Competing contexts of an anchor are
compared window by window: windows are sorted by hash, and neighbours must agree in all 35 words.

Edge cases: a null text has no words. A text that occurs in several rows, repeated ids included, is
removed from all of them if it has 35 words or more. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import count_words, stored, words
from .flat import chunks, places, prefix_sums, scramble, span_hash, word_bounds, word_hashes
from .spans import agreed, batch_of, by_text, compared, consecutive, forget, mask, of_documents, unique_texts

WINDOW = 35
ROUNDS = 3
#: Words that a symbol may stand for.
MOST = 8
#: Salts to name under before giving up.
SALTS = 8
#: Pairs of windows that are compared word for word at once.
SLICE = 8192
_SALT = np.uint64(0xD6E8FEB86659FD93)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _shifted(values: np.ndarray, by: int, edge: int) -> np.ndarray:
    """values[i + by], or ``edge`` beyond the ends."""
    out = np.full(len(values), edge, values.dtype)
    if by < 0:
        out[-by:] = values[:by]
    else:
        out[:len(values) - by] = values[by:]
    return out


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS, most: int = MOST) -> tuple[np.ndarray, ...]:
    """(name, first word, words, low, high) of the symbols left after the rounds.

    ``low`` to ``high`` are the words that decide a symbol. At a document's edge they reach beyond it, as
    an equal stretch elsewhere may go on.
    """
    n = len(names)
    start, size = np.arange(n), np.ones(n, np.int64)
    low, high = start.copy(), start + 1
    beyond = n + WINDOW

    def step(by: int) -> tuple[np.ndarray, np.ndarray]:
        """low and high of the symbol ``by`` places on, beyond all words where another document begins."""
        there = _shifted(doc, by, -1) == doc
        return np.where(there, _shifted(low, by, 0), -beyond), np.where(there, _shifted(high, by, 0), beyond)

    for turn in range(rounds):
        # Runs: a whole run gets a name, unless it is too long; then its symbols stay as they are.
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(names)))
        run = np.cumsum(new) - 1
        long = (count * size[first] > most)[run]
        lows, highs = step(-1)[0], step(1)[1]
        reach = np.arange(1, most + 2)
        for by in reach[1:].tolist():  # a long run shows itself within ``most`` words
            far = long & (size * (by - 1) <= most)
            lows, highs = np.where(far, np.minimum(lows, step(-by)[0]), lows), np.where(far, np.maximum(highs, step(by)[1]), highs)
        low, high = np.minimum(low, lows), np.maximum(high, highs)
        merged = (count > 1) & ~long[first]
        keep = new | long
        last = first + count - 1
        named = names.copy()
        named[first[merged]] = scramble(names[first[merged]] + scramble(count[merged].astype(np.uint64) + _SALT))
        size = size.copy()
        size[first[merged]] *= count[merged]
        high[first[merged]] = high[last[merged]]
        names, start, size, low, high, doc = (x[keep] for x in (named, start, size, low, high, doc))

        # Pairs: left symbol on side 0, right one on side 1.
        coin = (scramble((names ^ _SALT) + np.uint64(turn)) & np.uint64(1)).astype(bool)
        left = np.zeros(len(names), bool)
        left[:-1] = ~coin[:-1] & coin[1:] & (doc[:-1] == doc[1:]) & (size[:-1] + size[1:] <= most)
        lows, highs = np.where(coin, step(-1)[0], low), np.where(coin, high, step(1)[1])
        low, high = np.minimum(low, lows), np.maximum(high, highs)
        at = np.flatnonzero(left)
        named = names.copy()
        named[at] = scramble(scramble(names[at]) * _SALT + names[at + 1])
        size = size.copy()
        size[at] += size[at + 1]
        low[at], high[at] = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, start, size, low, high, doc = (x[keep] for x in (named, start, size, low, high, doc))
    return names, start, size, low, high


def smallest_inside(key: np.ndarray, low: np.ndarray, high: np.ndarray, windows: int) -> np.ndarray:
    """For each window, the smallest key of the symbols whose deciding words it holds.

    A symbol belongs to consecutive windows; their range is laid out as two blocks of a power of two, and
    blocks hand their minima down to halves.
    """
    first, last = np.maximum(high - WINDOW, 0), np.minimum(low, windows - 1)
    fits = (high - low <= WINDOW) & (low >= 0) & (first <= last)
    key, first, last = key[fits], first[fits], last[fits]
    level = np.floor(np.log2(last - first + 1)).astype(np.int64)
    top = WINDOW.bit_length()
    lowest = np.full((top, windows), _NONE)
    for k in range(top):
        on = level == k
        np.minimum.at(lowest[k], first[on], key[on])
        np.minimum.at(lowest[k], last[on] - (1 << k) + 1, key[on])
    for k in range(top - 1, 0, -1):
        half = 1 << (k - 1)
        np.minimum(lowest[k - 1], lowest[k], out=lowest[k - 1])
        np.minimum(lowest[k - 1][half:], lowest[k][:-half], out=lowest[k - 1][half:])
    return lowest[0]


def find_runs(batch: pa.RecordBatch, salt: int = 0, bits_kept: int = 64) -> Iterator[tuple]:
    """Runs of windows with one anchor, chunk by chunk; places count words. Hashes depend on ``salt``; only
    ``bits_kept`` bits of a context's are used."""
    for row, data, offsets in chunks(batch, "text"):
        begins, ends, first_word = word_bounds(data, offsets)
        n = len(begins) - WINDOW + 1
        if n < 1:
            continue
        hashes = scramble(word_hashes(data, begins, ends) + np.uint64(salt))
        counts = np.diff(first_word)
        doc = np.repeat(np.arange(len(counts)), counts)
        names, start, size, low, high = recompress(hashes, doc)
        named = scramble(names)
        bits = np.uint64(max(20, int(len(names)).bit_length()))
        # Long symbols first: they are rarer anchors.
        key = ((MOST - size).astype(np.uint64) << np.uint64(60)) | (named >> np.uint64(4))
        best = smallest_inside((key >> bits << bits) | np.arange(len(names), dtype=np.uint64), low, high, n)
        alone = best == _NONE
        symbol = np.where(alone, 0, best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        place = np.where(alone, np.arange(n), start[symbol])
        sums = prefix_sums(hashes)
        whole = np.repeat(first_word[1:], counts)[:n] - np.arange(n) >= WINDOW
        before = np.concatenate([[False], whole[:-1]])
        moved = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (alone[1:] != alone[:-1])]) | alone
        new = whole & (moved | ~before)
        first = np.flatnonzero(new)
        edges = np.append(np.flatnonzero(new | (before & ~whole)), n)
        length = edges[np.searchsorted(edges, first, "right")] - first
        off = place[first] - first
        content = span_hash(sums, first, first + length + (WINDOW - 1))
        context = scramble(content + scramble((length * 128 + off).astype(np.uint64))) >> np.uint64(64 - bits_kept)
        anchor = np.where(alone[first], scramble(content + _SALT), named[symbol[first]])
        yield row, doc[first], anchor, context, first - first_word[doc[first]], length, off


def spaced(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words with one blank after each, start of each word and the total)."""
    size = ends - begins + 1
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.append(data, np.uint8(0))[np.arange(at[-1]) + np.repeat(begins - at[:-1], size)]
    out[at[1:] - 1] = 0x20
    return out, at


def fetch_words(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The words that each run's windows cover, a blank after each; rows ascend."""
    parts = [pa.array([], pa.binary())]
    for base, data, offsets in chunks(batch, "text"):
        of_chunk = slice(*np.searchsorted(row, [base, base + len(offsets) - 1]))
        if of_chunk.start == of_chunk.stop:
            continue
        begins, ends, first_word = word_bounds(data, offsets)
        text, at = spaced(data, begins, ends)
        first = first_word[row[of_chunk] - base] + start[of_chunk]
        size = at[first + length[of_chunk] + (WINDOW - 1)] - at[first]
        cuts = np.concatenate([[0], np.cumsum(size)])
        body = text[np.arange(cuts[-1]) + np.repeat(at[first] - cuts[:-1], size)]
        parts.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(body)]))
    return pa.concat_arrays(parts)


def _equal(text: np.ndarray, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the stretches of ``size`` bytes at x and y are equal, byte by byte."""
    out = np.ones(len(x), bool)
    for low in range(0, len(x), SLICE):
        part = slice(low, low + SLICE)
        n = size[part]
        cuts = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(cuts, n)
        agree = text[step + np.repeat(x[part], n)] == text[step + np.repeat(y[part], n)]
        out[part] = np.logical_and.reduceat(agree, cuts)
    return out


def repeated(text: np.ndarray, at: np.ndarray, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the windows that begin at the words ``first`` occur more than once. ``hashes`` are theirs."""
    order = np.argsort(hashes, kind="stable")
    low, size = at[first], at[first + WINDOW] - at[first]
    x, y = order[:-1], order[1:]
    alike = hashes[x] == hashes[y]
    equal = alike & (size[x] == size[y])
    pairs = np.flatnonzero(equal)
    equal[pairs] = _equal(text, low[x[pairs]], low[y[pairs]], size[x[pairs]])
    hit = np.zeros(len(first), bool)
    hit[x[equal]] = True
    hit[y[equal]] = True
    # Where a hash lied, equal windows need not be neighbours: those hashes are settled by the words themselves.
    unsure = np.flatnonzero(np.isin(hashes, hashes[y[alike & ~equal]]))
    words_of = [text[low[i]:low[i] + size[i]].tobytes() for i in unsure]
    counts = Counter(words_of)
    hit[unsure] = [counts[words] > 1 for words in words_of]
    return hit


def match_windows(batch: pa.RecordBatch, length: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that another context has too, as (row, first window, number)."""
    cuts, data = places(batch.column("content"))
    text = data[cuts[0]:cuts[-1]]
    at = np.concatenate([[0], np.flatnonzero(text == 0x20) + 1])
    hashes = word_hashes(text, at[:-1], at[1:] - 1)
    row = np.repeat(np.arange(len(length)), length)
    window = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    first = np.searchsorted(at, cuts[:-1] - cuts[0])[row] + window
    hit = repeated(text, at, first, scramble(span_hash(prefix_sums(hashes), first, first + WINDOW)))
    return consecutive(row[hit], window[hit])


_RESULT = "doc_id long, text_hash long, n_removed long, kept_sha256 string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, sha = [], []
        for row, (text, copies) in enumerate(zip(batch.column("text"), batch.column("copies").to_pylist())):
            found = text.as_py().encode().split()
            gone = mask(batch, row, len(found))
            if copies > 1 and len(found) >= WINDOW:
                gone[:] = True
            removed.append(int(gone.sum()))
            kept = [w for w, g in zip(found, gone.tolist()) if not g] if removed[-1] else found
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield batch_of([part.split()[0] for part in _RESULT.split(", ")], [
            batch.column("doc_id"), batch.column("text_hash"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
        ])


def repeated_spans(docs: DataFrame, finders: Iterable[Callable] | None = None) -> tuple[DataFrame, str]:
    """(doc_id, text_hash, copies, text, spans): the (start, end) word spans to remove of each different text.

    ``finders`` are versions of ``find_runs``, tried in turn until one's hashes tell all contexts apart.
    """
    texts, name = unique_texts(docs)
    marks = agreed(texts, finders or [partial(find_runs, salt=salt) for salt in range(SALTS)], fetch_words, everywhere=True)
    return by_text(texts, marks, compared(texts, marks, fetch_words, match_windows), WINDOW), name


def digest(docs: DataFrame, finders: Iterable[Callable] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the hash of the words that stay."""
    found, name = repeated_spans(docs, finders)
    results = stored(found.mapInArrow(_kept, _RESULT), "kept")
    forget(docs.sparkSession, name)
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), count_words(F.col("text")).alias("n_words"),
        F.when(count_words(F.col("text")) < WINDOW, F.array_join(words(F.col("text")), " ")).otherwise("").alias("whole"),
    )
    long = F.col("n_words") >= WINDOW
    return of_documents(rows, results).select(
        "doc_id", "n_words", F.coalesce("n_removed", F.when(long, F.col("n_words")).otherwise(0)).alias("n_removed"),
        F.coalesce("kept_sha256", F.sha2(F.col("whole").cast("binary"), 256)).alias("kept_sha256"),
    )


#: What ``digest`` returns, by counting windows as text.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM twice),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS words
         FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""
