"""Vector code compression: product codes whose nearest entries are found in the Walsh-Hadamard domain.

A vector is cut into equal parts, each with a codebook of its own. Parts and entries, filled with zeros to a
power of two p, go through the integer Walsh-Hadamard transform, which multiplies every squared distance by p.
Coefficients are kept in sequency order (by sign changes), so that the slow ones, which hold most of a smooth
part, come first. Squared differences are added up in growing blocks of them; an entry leaves as soon as its
sum exceeds the full distance of the entry that led after the first block. All of it is whole numbers, so
ties and distances are exact.

Parts are transformed once and stored. A round of training is one scan: a task adds up the transformed parts of
each entry, partial sums meet in a shuffle of (parts x entries x p) numbers a task, and so many numbers in
all reach the driver, whatever the number of vectors. The transform is linear, so the inverse transform of a sum,
divided by p, is the sum of the parts.

Edge cases: vectors that are null or hold a null, NaN or infinite component are left out. Vectors of different
length, or of a length that the number of parts does not divide, are filled with zeros at their end. Codebooks
start from the rows with the smallest (vec_id, vector), null ids last; with fewer rows there are fewer entries. Repeated rows
count as often as they occur. Scaled components stop at 2^40 on either side, and an error beyond 64 bits is given as
the largest long. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import same, stored
from .vectors import LONG, as_long, matrix, whole_vectors

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Rows that are compared at once.
SLICE = 4096
#: Labels whose totals are broadcast; more are shuffled, in salted shares.
BROADCAST_ROWS = 100_000
SALTS = 32


def sequency_order(p: int) -> np.ndarray:
    """Places of the natural transform's coefficients, by their functions' sign changes."""
    changes = np.abs(np.diff(hadamard(np.eye(p, dtype=np.int64)), axis=1)).sum(axis=1)
    return np.argsort(changes, kind="stable")


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row, in natural order; the row length is a power of two."""
    rows, p = x.shape
    half = 1
    while half < p:
        pairs = x.reshape(rows, p // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, p)
        half *= 2
    return x


def transformed(parts: np.ndarray, p: int) -> np.ndarray:
    """Rows filled with zeros to ``p``, transformed, in sequency order."""
    filled = np.zeros((len(parts), p), parts.dtype)
    filled[:, :parts.shape[1]] = parts
    return hadamard(filled)[:, sequency_order(p)]


def restored(coefficients: np.ndarray, width: int) -> np.ndarray:
    """The rows that ``transformed`` was given."""
    p = coefficients.shape[1]
    natural = np.zeros_like(coefficients)
    natural[:, sequency_order(p)] = coefficients
    return hadamard(natural)[:, :width] // p


def _exact(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit numbers where no sum of squares can leave them, else as unbounded ones."""
    largest = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    if max(parts.shape[1], 1) * (2 * largest) ** 2 < LONG:
        return parts.astype(np.int64), entries.astype(np.int64)
    return parts.astype(object), entries.astype(object)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, p times the squared distance) of each row; ties go to the lower entry."""
    parts, entries = _exact(parts, entries)
    n, p = parts.shape
    done = max(p // 4, 1)
    sums = ((parts[:, None, :done] - entries[None, :, :done]) ** 2).sum(axis=2)
    leader = sums.argmin(axis=1)
    bound = ((parts - entries[leader]) ** 2).sum(axis=1)
    alive = sums <= bound[:, None]
    while done < p:
        end = min(2 * done, p)
        row, entry = np.nonzero(alive)
        sums[row, entry] += ((parts[row, done:end] - entries[entry, done:end]) ** 2).sum(axis=1)
        alive[row, entry] = sums[row, entry] <= bound[row]
        done = end
    sums[~alive] = bound.max() + 1 if n else 0
    best = sums.argmin(axis=1)
    return best, sums[np.arange(n), best]


Codebooks = list[np.ndarray]


def _assigned(v: np.ndarray, books: Codebooks) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its transformed rows, entries, scaled distances) of each part position."""
    p = v.shape[1] // len(books)
    for part, book in enumerate(books):
        own = v[:, part * p:(part + 1) * p]
        yield part, own, *nearest(own, book)


def _transform(parts: int, width: int, p: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"), parts * width)
            made = transformed(v.reshape(-1, width), p).reshape(len(batch), parts * p)
            flat = pa.array(made.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * (parts * p), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "v"), lists],
                                             [*(c for c in batch.schema.names if c != "v"), "v"])

    return run


def _gather(books: Codebooks) -> Callable:
    """What a task adds up for each entry: (part, entry, place, total); place -1 counts the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, (k, p) = len(books), books[0].shape
        totals = np.zeros((parts, k, p + 1), object)
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                v = matrix(batch.column("v").slice(start, SLICE), parts * p)
                wide = object if v.size and int(np.abs(v).max()) >= LONG // SLICE else np.int64
                for part, own, entry, _ in _assigned(v, books):
                    order = np.argsort(entry, kind="stable")
                    used, first, count = np.unique(entry[order], return_index=True, return_counts=True)
                    totals[part, used, 0] += count.astype(object)
                    totals[part, used, 1:] += np.add.reduceat(own[order].astype(wide), first, axis=0).astype(object)
        part, entry, place = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place - 1, pa.int32()),
             pa.array([Decimal(int(x)) for x in totals[part, entry, place]], pa.decimal128(38, 0))],
            ["part", "entry", "place", "total"],
        )

    return run


def prepared(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, DataFrame, int]:
    """(whole vectors, stored rows of (vec_id, label, v) with transformed parts, width of a part)."""
    whole, dimension = whole_vectors(vectors, scale, parts, ["vec_id", "label"])
    width = dimension // parts
    p = 1 << max(width - 1, 0).bit_length()
    schema = whole.schema.simpleString()[len("struct<"):-1]
    return whole, stored(whole.mapInArrow(_transform(parts, width, p), schema), "vector-parts"), width


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(transformed vectors as ``encode`` takes them, codebooks: a whole-number matrix of entries for each part)."""
    whole, rows, width = prepared(vectors, parts, scale)
    p = 1 << max(width - 1, 0).bit_length()
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width)
    books = [start[:, part].astype(object) for part in range(parts)]
    for _ in range(rounds if first else 0):
        sums = np.zeros((parts, len(first), p + 1), object)
        totals = (
            rows.select("v").mapInArrow(_gather([transformed(b, p) for b in books]), "part int, entry int, place int, total decimal(38,0)")
            .groupBy("part", "entry", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
        )
        for part, entry, place, total in totals.collect():
            sums[part, entry, place + 1] = int(total)
        for part, book in enumerate(books):
            used = np.flatnonzero(sums[part, :, 0])
            book[used] = restored(sums[part, used, 1:], width) // sums[part, used, :1]
    return rows, books


def _encode(books: Codebooks) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = books[0].shape[1]
        for batch in batches:
            for start in range(0, len(batch), SLICE):
                rows = batch.slice(start, SLICE)
                v = matrix(rows.column("v"), len(books) * p)
                chosen = np.zeros((len(rows), len(books)), np.uint8)
                error = np.zeros(len(rows), object)
                for part, _, entry, distance in _assigned(v, books):
                    chosen[:, part] = entry
                    error += distance.astype(object) // p
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), pa.array([c.tobytes().hex() for c in chosen], pa.string()),
                     pa.array(as_long(error), pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of transformed vectors; two hex digits for each part, so 256 entries at the most."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if not len(books[0]):
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).where(F.lit(False))
    p = 1 << max(books[0].shape[1] - 1, 0).bit_length()
    return rows.mapInArrow(_encode([transformed(b, p) for b in books]), schema)


def fingerprint(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors of the same label together; rows with a null label form one group."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    totals = stored(coded.groupBy("label").agg(total.alias("label_error")), "label-errors")
    if totals.count() <= BROADCAST_ROWS:
        return coded.alias("c").join(F.broadcast(totals.alias("s")), same("c", "s", ["label"])).select("c.*", "label_error")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    shares = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    return salted.alias("c").join(shares.alias("s"), same("c", "s", ["label", "salt"])).select("c.*", "label_error").drop("salt")


def digest(vectors: DataFrame) -> DataFrame:
    rows, books = train(vectors)
    coded = stored(encode(rows, books), "vector-codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds written out one after the other, distances by components; takes lengths that 8 divides."""
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
       list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """x AS MATERIALIZED (SELECT r, (i - 1) // (n // 8) AS p, (i - 1) % (n // 8) AS i, c[i] AS a
  FROM (SELECT r, c, len(c) AS n, unnest(range(1, len(c) + 1)) AS i FROM v))""",
        "b0 AS MATERIALIZED (SELECT p, r AS e, i, a FROM x WHERE r < 16)",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"""n{k} AS MATERIALIZED (SELECT r, p, min(s * 16 + e) % 16 AS e, min(s) AS s FROM
  (SELECT x.r, x.p, b.e, sum((x.a - b.a) * (x.a - b.a))::BIGINT AS s FROM x JOIN b{k} b ON b.p = x.p AND b.i = x.i GROUP BY x.r, x.p, b.e)
  GROUP BY r, p)""")
        if k < ROUNDS:
            steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, b.i, coalesce(m.a, b.a) AS a FROM b{k} b LEFT JOIN
  (SELECT p, e, i, ((t - ((t % n) + n) % n) // n)::BIGINT AS a FROM
    (SELECT x.p, n.e, x.i, sum(x.a)::BIGINT AS t, count(*)::BIGINT AS n FROM x JOIN n{k} n ON n.r = x.r AND n.p = x.p GROUP BY x.p, n.e, x.i)) m
  ON m.p = b.p AND m.e = b.e AND m.i = b.i)""")
    steps.append(f"""f AS MATERIALIZED (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(s)::BIGINT AS error
  FROM n{ROUNDS} GROUP BY r)""")
    steps.append(f"h AS (SELECT sha256(string_agg(a::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM b{ROUNDS})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM h) AS codebooks_sha256
FROM v JOIN f USING (r)"""


#: What ``digest`` returns.
SQL = _sql()
