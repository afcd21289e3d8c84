"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A text is cut into pre-tokens; a pre-token's best segmentation into pieces of the vocabulary is the one with the
largest sum of log-probabilities, of equal ones that with fewer pieces. The forward score of a prefix
does not depend on what follows, so pre-tokens are walked in sorted order, which is a depth-first walk of
their trie: scores of the prefix shared with the one before are kept, the rest is computed once, and the
terminal's count and score are stored. Each task does this for the pre-tokens it has not met yet, and
sums the stored counts per text. Nothing is shuffled.

The model is a public byte-level vocabulary, read through Spark and broadcast; a piece's
log-probability follows from its rank by Zipf's law. All single bytes are pieces, so any text has a
segmentation.

Edge cases: a null or empty text has no pre-tokens, no tokens and score 0. Equal texts get equal results, row
by row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Where the registered query finds its vocabulary: lines of base64 piece and rank.
VOCABULARY = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary larger than this is not broadcast.
MOST_PIECES = 1_000_000
#: Terminals that a task stores before it starts afresh.
MOST_STORED = 2_000_000
#: Bytes of text that are cut at a time.
SLICE_BYTES = 4 << 20
PRETOKEN = re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+")
RESULT = "doc_id long, n_pretokens long, n_tokens long, score double"


class Trie:
    """Forward scores along the current path, and the terminals' counts and scores."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = pieces
        self.endings = {piece[i:] for piece in pieces for i in range(len(piece))}
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.counts, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def insert(self, words: set[bytes]) -> None:
        """Store the terminals of new words."""
        path, score, count = b"", [0.0], [0]
        counts, scores = [], []
        pieces, endings = self.pieces, self.endings
        for word in sorted(words):
            shared = _shared(path, word)
            del score[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                best, least = -math.inf, 0
                for start in range(end - 1, -1, -1):
                    piece = word[start:end]
                    if piece not in endings:
                        break
                    gain = pieces.get(piece)
                    if gain is not None:
                        total, n = score[start] + gain, count[start] + 1
                        if total > best or (total == best and n < least):
                            best, least = total, n
                score.append(best)
                count.append(least)
            path = word
            self.number[word] = len(self.number)
            counts.append(count[-1])
            scores.append(score[-1])
        self.counts = np.concatenate([self.counts, np.array(counts, np.int64)])
        self.scores = np.concatenate([self.scores, np.array(scores)])


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def zipf(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log-probability of each piece by its rank."""
    total = math.log(sum(1 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


def vocabulary(spark: SparkSession, path: str = VOCABULARY) -> dict[bytes, float]:
    lines = spark.read.text(path).limit(MOST_PIECES + 1).collect()
    if len(lines) > MOST_PIECES:
        raise ValueError(f"more than {MOST_PIECES} pieces in {path}")
    pairs = (row[0].split() for row in lines if row[0].strip())
    return zipf({base64.b64decode(piece): int(rank) for piece, rank in pairs})


def token_counts(docs: DataFrame, pieces: dict[bytes, float]) -> DataFrame:
    """Per row of ``docs``: doc_id, n_pretokens, n_tokens and the best segmentation's log-probability."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            texts = batch.column("text")
            out: list[tuple[int, int, float]] = []
            row = 0
            while row < len(texts):
                cut, held = [], 0
                while row < len(texts) and (held < SLICE_BYTES or not cut):
                    body = (texts[row].as_py() or "").encode()
                    cut.append(PRETOKEN.findall(body))
                    held += len(body)
                    row += 1
                if len(trie.number) > MOST_STORED:
                    trie.clear()
                trie.insert({word for found in cut for word in found} - trie.number.keys())
                for found in cut:
                    at = np.fromiter(map(trie.number.__getitem__, found), np.int64, len(found))
                    out.append((len(found), int(trie.counts[at].sum()), float(trie.scores[at].sum())))
            n, tokens, score = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array(score, pa.float64())],
                [part.split()[0] for part in RESULT.split(", ")],
            )

    return docs.select("doc_id", "text").mapInArrow(count, RESULT)
