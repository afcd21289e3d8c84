"""Near copies: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

A set of n shingles that is similar to another shares, under any order of all shingles, one of its
first n - ceil(0.8 n) + 1 with the other's. Three orders are used: two put shingles that many sets
share last and otherwise follow different hashes, the third is the exact order by frequency among the
sets that are left. Before that, sets drop out of which fewer than 0.8 n shingles occur in any other set: an order
that puts unshared shingles first would leave them no prefix list. Sets that meet in some prefix list form clusters. Clusters of the first order are
split by the second order's lists inside each cluster, and again by the third's, so a candidate shares
prefix shingles under every order, and only candidates are compared exactly. A cluster of up to half of
``GROUP_TOKENS`` is brought together after the second order and split by the third and compared in one
call; a larger one is split by the third order through shuffled lists, and what is left is brought together.

No pair is written before it is verified: lists become stars around their smallest member, and the
comparison inside a cluster walks from each set to the ones not reached yet. Equal sets are one entity
from the start. A cluster over ``GROUP_TOKENS`` is compared in pairs of blocks, so memory stays bounded
while every pair of sets still meets once.

Shingles and sets are compared by 64-bit hashes, sets additionally by a second sum. The count of shared shingles
works on shorter hashes, which can only raise it.

Edge cases: null texts and texts without words have empty sets and are linked with nothing; their
component is their own id. Fewer than five words make one shingle. Documents that repeat an id are
compared by their own texts; a component's id is its smallest non-null id. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_batches, as_rows, same, stored
from .components import components
from .flat import chunks, grams, lower_ascii, places, scramble, word_bounds, word_hashes

SHINGLE = 5
PERCENT = 80
#: The commonest shingles that the orders put last; which ones does not change results.
HEAVY = 1 << 20
#: Occurrences in a batch from which a shingle is reported as common.
REPEATED = 2
#: Members of a list that stay together; longer lists are split, and their stars meet in their centres.
LIST_ROWS = 20_000
#: Shingles that are held at once while sets are compared.
GROUP_TOKENS = 2_000_000
#: Occurrences of shingles that are brought together at once to see which ones several sets share.
PART_TOKENS = 600_000
#: Shingles of one set that a run has at the most: its length travels as one byte, and a longer run as several.
RUN_TOKENS = 255
#: Counts of sets that are added up in one call.
BUCKET_COUNTS = 2_000_000
#: Shingles whose order is worked out at once.
SLICE_TOKENS = 250_000
#: Shingles and sets that a task remembers while it counts shared shingles.
REMEMBERED = 1 << 19
REMEMBERED_SETS = 1 << 17
#: Bytes of texts or sets that a task gets at once; what is found does not depend on it.
BATCH_BYTES = 1 << 22
#: Candidate sets whose keys are broadcast to fetch their texts; more are shuffled.
BROADCAST_ROWS = 500_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, offsets): each document's distinct shingle hashes in ascending order."""
    data = lower_ascii(data)
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(np.arange(len(hashes)) + SHINGLE <= np.repeat(first[1:], counts))
    tokens, owner = [grams(hashes, SHINGLE)[whole]], [doc[whole]]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        if len(short):
            tokens.append(grams(hashes, n, n)[first[short]])
            owner.append(short)
    token, doc = np.concatenate(tokens), np.concatenate(owner)
    order = np.lexsort((token, doc))
    token, doc = token[order], doc[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    token, doc = token[fresh], doc[fresh]
    return token, np.searchsorted(doc, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _weights(token: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How common each shingle is; 0 for those that are not listed."""
    if not len(heavy[0]):
        return np.zeros(len(token), np.int64)
    at = np.minimum(np.searchsorted(heavy[0], token), len(heavy[0]) - 1)
    return np.where(heavy[0][at] == token, heavy[1][at], 0)


def _prefixes(token: np.ndarray, offsets: np.ndarray, order: int, heavy: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, offsets) of each set's prefix under one order."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    weight = _weights(token, heavy)
    by = np.lexsort((scramble(token + np.uint64(order)), weight, doc))
    length = np.where(sizes > 0, sizes - (PERCENT * sizes + 99) // 100 + 1, 0)
    rank = np.arange(len(token)) - np.repeat(offsets[:-1], sizes)
    chosen = by[rank < np.repeat(length, sizes)]
    return token[chosen], weight[chosen], np.concatenate([[0], np.cumsum(length)])


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per row from a flat array of numbers."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))],
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat array of 64-bit values and offsets of a binary column without nulls."""
    at, data = places(column)
    return data[at[0]:at[-1]].view(np.uint64), (at - at[0]) // 8


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, shingles, offsets) of slices of batches with ``shingles``, so that a slice's arrays stay small."""
    for batch in batches:
        at = places(batch.column("shingles"))[0] // 8
        row = 0
        while row < len(batch):
            end = max(int(np.searchsorted(at, at[row] + SLICE_TOKENS, "right")) - 1, row + 1)
            part = batch.slice(row, end - row)
            yield part, *_flat(part.column("shingles"))
            row = end


def _common_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n): shingles of several sets of a batch."""
    for _, token, _ in _pieces(batches):
        token, n = np.unique(token, return_counts=True)
        often = n >= REPEATED
        yield pa.RecordBatch.from_arrays([pa.array(_signed(token[often])), pa.array(n[often])], ["token", "n"])


def common_shingles(sets: DataFrame, most: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, weights), sorted: the commonest shingles, ``most`` at the most.

    Only shingles that repeat inside some batch are counted: a shingle of many sets does.
    The weight decides an order of shingles and nothing else, so neither the batches nor the limit
    change what is found.
    """
    counted = stored(
        sets.select("shingles").mapInArrow(_common_in_batch, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")),
        "common-shingles",
    )
    classes = counted.groupBy(F.floor(F.log2("n")).alias("c")).count().orderBy(F.desc("c")).collect()
    least, total = None, 0
    for row in classes:
        total += row["count"]
        if total > most:
            break
        least = 1 << int(row["c"])
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    chosen = counted.where(F.col("n") >= least).toPandas()
    token = chosen["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], chosen["n"].to_numpy(np.int64)[order]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in chunks(batch, "text"):
            token, at = shingle_sets(data, offsets)
            part = batch.slice(row, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(at)),
                 pa.array(_signed(_sums(scramble(token), at))), pa.array(_signed(_sums(scramble(~token), at)))],
                ["doc_id", "text_hash", "n_shingles", "entity", "check"],
            )


_OCCURRENCES = "part long, tokens binary, marks binary, entities binary, counts binary"


def _occurrences(parts: int, buckets: int) -> Callable:
    """Shingles that a task has met in one set only, by part of the hash range, with their sets.

    A shingle that the task has met in two sets is shared for sure: it is sent once, as a mark without sets, and its sets'
    counts go to negative parts, one for each bucket of sets. So a common shingle costs a few rows a task.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.zeros(0, np.uint64), set()
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                token, at = shingle_sets(data, offsets)
                sizes = np.diff(at)
                entity = _sums(scramble(token), at)
                new = np.array([n > 0 and e not in seen and not seen.add(e) for e, n in zip(entity.tolist(), sizes.tolist())], bool)
                token, owner = token[np.repeat(new, sizes)], np.repeat(entity, np.where(new, sizes, 0))
                order = np.argsort(token, kind="stable")
                token, owner = token[order], owner[order]
                starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
                times, distinct = np.diff(np.append(starts, len(token))), token[starts]
                old = np.isin(distinct, known, assume_unique=True, kind="sort")
                marks = distinct[(times > 1) & ~old]
                here = np.repeat((times > 1) | old, times)
                yield _by_part(token[~here], owner[~here], marks, parts)
                yield _by_bucket(*np.unique(owner[here], return_counts=True), buckets)
                known = np.union1d(known, marks) if len(known) < REMEMBERED else marks
                if len(seen) > REMEMBERED_SETS:
                    seen.clear()

    return spread


def _by_part(token: np.ndarray, owner: np.ndarray, marks: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part of the hash range: low halves of its shingles in the order of their sets, and of its marks."""
    part, mark_part = ((x >> np.uint64(32)) % np.uint64(parts) for x in (token, marks))
    order, mark_order = np.lexsort((owner, part)), np.argsort(mark_part, kind="stable")
    token, owner, part = token[order], owner[order], part[order]
    runs = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])])) if len(token) else np.zeros(0, int)
    inside = np.arange(len(token)) - np.repeat(runs, np.diff(np.append(runs, len(token))))
    runs = np.flatnonzero(inside % RUN_TOKENS == 0)
    every = np.unique(np.concatenate([part, mark_part]))

    def cut(values: np.ndarray) -> np.ndarray:
        return np.append(np.searchsorted(values, every), len(values))

    return pa.RecordBatch.from_arrays([
        pa.array(_signed(every)), _binary(token.astype(np.uint32), cut(part)),
        _binary(marks[mark_order].astype(np.uint32), cut(mark_part[mark_order])),
        _binary(owner[runs], cut(part[runs])), _binary(np.diff(np.append(runs, len(token))).astype(np.uint8), cut(part[runs])),
    ], [name.split()[0] for name in _OCCURRENCES.split(", ")])


def _by_bucket(entity: np.ndarray, count: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Counts of shared shingles, a row for each bucket of sets; buckets are negative parts."""
    bucket = (scramble(entity) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    every, first = np.unique(bucket[order], return_index=True)
    cut = np.append(first, len(order))
    none = _binary(np.zeros(0, np.uint32), np.zeros(len(every) + 1, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(-1 - every), none, none, _binary(entity[order], cut), _binary(count[order].astype(np.uint32), cut)],
        [name.split()[0] for name in _OCCURRENCES.split(", ")],
    )


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All values of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _count_shared(buckets: int) -> Callable:
    """How many of a set's shingles in one part of the hash range others have too, by bucket of sets; counts pass through."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("part")[0].as_py() >= 0:
            token, marks = _joined(group.column("tokens"), np.uint32), _joined(group.column("marks"), np.uint32)
            entity, place = np.unique(_joined(group.column("entities"), np.uint64), return_inverse=True)
            owner = np.repeat(place.astype(np.int32), _joined(group.column("counts"), np.uint8))
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            del order, place
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
            shared = np.isin(token[starts], marks)
            if len(starts):
                shared |= np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
            count = np.bincount(owner[np.repeat(shared, np.diff(np.append(starts, len(token))))], minlength=len(entity))
            group = pa.Table.from_batches([_by_bucket(entity[count > 0], count[count > 0], buckets)])
        # the session may send wide offsets, but takes none back
        return group.select(["part", "entities", "counts"]).cast(pa.schema([("part", pa.int64()), ("entities", pa.binary()), ("counts", pa.binary())]))

    return run


def _add_up(group: pa.Table) -> pa.Table:
    entity, place = np.unique(_joined(group.column("entities"), np.uint64), return_inverse=True)
    total = np.bincount(place, _joined(group.column("counts"), np.uint32), len(entity)).astype(np.int64)
    return pa.table({"entity": _signed(entity), "shared": total})


def shared_shingles(docs: DataFrame, shingles: int, sets: int) -> DataFrame:
    """(entity, shared): how many of a set's shingles occur in other sets, or more than that; sets without any are left out.

    ``shingles`` and ``sets`` are the numbers in all ``docs``; they decide how finely work is cut. A part sends one count for
    each of its sets, so there are at most ``sets`` times parts of them, and no more than shingles.
    Shingles travel as packed halves of hashes, four bytes each, and nine bytes for each run of a set's shingles in one part;
    the more parts there are, the shorter the runs, down to one shingle.
    """
    parts = shingles // PART_TOKENS + 1
    buckets = min(sets * parts, shingles) // BUCKET_COUNTS + 1
    spread = docs.select("text").mapInArrow(_occurrences(parts, buckets), _OCCURRENCES)
    counted = spread.groupBy("part").applyInArrow(_count_shared(buckets), "part long, entities binary, counts binary")
    return counted.groupBy("part").applyInArrow(_add_up, "entity long, shared long")


_LISTS = "list long, parent long, entity long"


def _lists(keys: np.ndarray, weights: np.ndarray, entity: np.ndarray) -> pa.RecordBatch:
    """Rows (list, parent, entity); a list whose shingle weighs much is split by entity, its parts share a parent."""
    parts = (weights // LIST_ROWS + 1).astype(np.uint64)
    split = parts > 1
    part = scramble(entity.view(np.uint64)) % parts
    listed = np.where(split, scramble(keys + scramble(part + np.uint64(1))), keys)
    return pa.RecordBatch.from_arrays(
        [pa.array(_signed(listed)), pa.array(_signed(keys), mask=~split), pa.array(entity)], ["list", "parent", "entity"]
    )


def _order_lists(heavy, order: int) -> Callable:
    """Lists of the prefixes under one order; a list belongs to one cluster, if there are clusters."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, token, at in _pieces(batches):
            prefix, weight, cut = _prefixes(token, at, order, heavy.value)
            sizes = np.diff(cut)
            if "cluster" in batch.schema.names:
                prefix = scramble(prefix + scramble(np.repeat(batch.column("cluster").to_numpy().view(np.uint64), sizes)))
            yield _lists(prefix, weight, np.repeat(batch.column("entity").to_numpy(), sizes))

    return lists


def _all_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (list, entity, need): every shingle inside its cluster; ``need`` of a set's shingles a similar set has."""
    for batch, token, at in _pieces(batches):
        sizes = np.diff(at)
        cluster = np.repeat(batch.column("cluster").to_numpy().view(np.uint64), sizes)
        entity = np.repeat(batch.column("entity").to_numpy(), sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(scramble(token + scramble(cluster)))), pa.array(entity), pa.array(np.repeat((PERCENT * sizes + 99) // 100, sizes))],
            ["list", "entity", "need"],
        )


def rarest_lists(sets: DataFrame) -> DataFrame:
    """Lists of the prefixes under the order by frequency inside the cluster, rarest first.

    A shingle that only one set of the cluster has comes first and makes no list, so of s shingles that others have
    too, the first s - need + 1 are left, and sets with fewer shared shingles than they need drop out.
    """
    # A set that repeated rows bring twice counts twice, which only lengthens its prefix.
    every = sets.select("entity", "cluster", "shingles").mapInArrow(_all_lists, "list long, entity long, need long")
    shared = every.withColumn("df", F.count("*").over(W.partitionBy("list"))).where("df > 1")
    own = W.partitionBy("entity")
    ranked = shared.withColumn("rank", F.row_number().over(own.orderBy("df", "list"))).withColumn("s", F.count("*").over(own))
    return ranked.where("rank <= s - need + 1").select("list", F.lit(None).cast("long").alias("parent"), "entity")


def clusters(lists: DataFrame) -> DataFrame:
    """(entity, cluster) of entities that meet another in some list, directly or through others.

    Each list is a star around its smallest member; the parts of a split list meet in these.
    """
    low = F.min("entity").over(W.partitionBy("list"))
    stars = stored(
        lists.withColumn("low", low).where("entity <> low or parent is not null").select("parent", "entity", "low").distinct(), "stars"
    )
    centres = stars.where("parent is not null").select("parent", F.col("low").alias("entity")).distinct()
    middle = centres.withColumn("low", F.min("entity").over(W.partitionBy("parent")))
    edges = stars.select("entity", "low").unionByName(middle.select("entity", "low"))
    return components(edges.select(F.col("entity").alias("a"), F.col("low").alias("b"))).select(
        F.col("node").alias("entity"), F.col("root").alias("cluster")
    )


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in chunks(batch, "text"):
            token, at = shingle_sets(data, offsets)
            part = batch.slice(row, len(offsets) - 1)
            made = pa.RecordBatch.from_arrays(
                [part.column("entity"), pa.array(np.diff(at)), _binary(token, at)], ["entity", "n", "shingles"],
            )
            once = np.unique(part.column("entity").to_numpy(), return_index=True)[1]  # repeated rows bring a set again
            yield made if len(once) == len(part) else made.take(pa.array(np.sort(once)))


def linked_pairs(entity: np.ndarray, token: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all similar sets: from each set to the similar ones that were not reached before."""
    token = np.unique(token, return_inverse=True)[1]
    sizes = np.diff(at)
    marked = np.zeros(int(token.max()) + 1 if len(token) else 0, np.int32)
    rest, found, reached = np.arange(len(entity)), [], []
    held = None
    while len(rest):
        if not reached:
            reached.append(rest[0])
            rest, held = rest[1:], None
            continue
        i = reached.pop()
        if held is None:
            held = np.concatenate([token[at[j]:at[j + 1]] for j in rest]), np.concatenate([[0], np.cumsum(sizes[rest])[:-1]])
        own = token[at[i]:at[i + 1]]
        marked[own] = 1
        shared = np.add.reduceat(marked[held[0]], held[1])
        marked[own] = 0
        near = 100 * shared >= PERCENT * (sizes[i] + sizes[rest] - shared)
        if near.any():
            hit = rest[near]
            found.append((np.full(len(hit), entity[i]), entity[hit]))
            reached.extend(hit.tolist())
            rest, held = rest[~near], None
    return found


def _meeting(entry_list: np.ndarray, entry_set: np.ndarray, sets: int) -> np.ndarray:
    """For each set the smallest number of those that it meets in some list, directly or through others."""
    order = np.argsort(entry_list, kind="stable")
    entry_list, entry_set = entry_list[order], entry_set[order]
    firsts = np.flatnonzero(np.concatenate([[True], entry_list[1:] != entry_list[:-1]])) if len(order) else order
    members = np.diff(np.append(firsts, len(order)))
    label = np.arange(sets)
    while len(order):
        low = np.repeat(np.minimum.reduceat(label[entry_set], firsts), members)
        new = label.copy()
        np.minimum.at(new, entry_set, low)
        np.minimum.at(new, label[entry_set], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def split_by_rarest(token: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sets of one cluster that meet under the order by frequency inside it, as ``rarest_lists`` has it; groups of two and more."""
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, token, df = np.unique(token, return_inverse=True, return_counts=True)
    shared = df[token] > 1
    token, owner = token[shared], owner[shared]
    order = np.lexsort((token, df[token], owner))
    token, owner = token[order], owner[order]
    left = np.bincount(owner, minlength=len(sizes))
    rank = np.arange(len(token)) - np.repeat(np.cumsum(left) - left, left)
    prefix = rank < np.repeat(left - (PERCENT * sizes + 99) // 100 + 1, left)
    label = _meeting(token[prefix], owner[prefix], len(sizes))
    order = np.argsort(label, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(label[order])) + 1)
    return [part for part in parts if len(part) > 1]


def _verify(group: pa.Table) -> pa.Table:
    """Links (a, b) inside each cluster of a group, among its sets that meet under the order by frequency."""
    group = group.combine_chunks()
    cluster = group.column("cluster").to_numpy()
    order = np.argsort(cluster, kind="stable")
    group, cluster = group.take(pa.array(order)), cluster[order]
    bounds = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]]))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    entity = group.column("entity").to_numpy()
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start > 1:
            token, at = _flat(group.column("shingles").slice(start, end - start).combine_chunks())
            for part in split_by_rarest(token, at):
                sizes = np.diff(at)[part]
                own = np.concatenate([token[at[i]:at[i + 1]] for i in part])
                for a, b in linked_pairs(entity[start:end][part], own, np.concatenate([[0], np.cumsum(sizes)])):
                    left.append(a)
                    right.append(b)
    return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})


def _small(df: DataFrame) -> DataFrame:
    """``df``, a stored table of a few numbers a row, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def in_blocks(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(entity, cluster, n, blocks): how many blocks a cluster is dealt into, 1 if it is small."""
    sized = stored(sets.select("entity", "n").distinct().join(labels, "entity"), "sized")
    half = GROUP_TOKENS // 2
    blocks = F.when(F.col("_n") <= half, 1).otherwise(F.ceil(F.col("_n") / half)).cast("int").alias("blocks")
    sizes = sized.groupBy("cluster").agg(F.sum("n").alias("_n")).select("cluster", blocks)
    return stored(sized.join(sizes, "cluster").select("entity", "cluster", "n", "blocks"), "placed")


def verified_links(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """(a, b): links between entities of one cluster, enough to connect all that are similar.

    Small clusters share groups; a large one is dealt into blocks, and each pair of blocks is a group.
    """
    bins = int((placed.agg(F.sum("n")).first()[0] or 0) // GROUP_TOKENS) + 1
    single = F.col("blocks") == 1
    block = F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int")
    others = F.when(single, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = sets.select("entity", "shingles").join(_small(placed.drop("n")), "entity").select(
        "cluster", "entity", "shingles", single.alias("single"), block.alias("block"), F.explode(others).alias("other"),
    ).select(
        "cluster", "entity", "shingles",
        F.when(F.col("single"), F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster")).alias("g"),
        F.when(F.col("single"), -1).otherwise(F.least("block", "other")).alias("i"),
        F.when(F.col("single"), -1).otherwise(F.greatest("block", "other")).alias("j"),
    )
    return grouped.groupBy("g", "i", "j").applyInArrow(_verify, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id and root, the component's own key (null without words)."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _near_copies(docs)


def _near_copies(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    described = stored(
        rows.mapInArrow(_describe, "doc_id long, text_hash long, n_shingles long, entity long, check long"), "shingle-counts"
    )
    identity = ["entity", "check"]
    entities = stored(
        described.where("n_shingles > 0").groupBy(*identity)
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("of"), F.first("n_shingles").alias("n"))
        .select(*identity, "of.doc_id", "of.text_hash", "n"),
        "entities",
    )
    sizes = entities.agg(F.sum("n"), F.count("*")).first()
    shared = shared_shingles(rows, sizes[0] or 0, sizes[1])
    wanted = stored(entities.join(shared, "entity").where(100 * F.col("shared") >= PERCENT * F.col("n")), "candidates")
    texts = rows.alias("t").join(_small(wanted).alias("w"), same("t", "w", ["doc_id", "text_hash"])).select("entity", "text")
    sets = stored(texts.mapInArrow(_with_sets, "entity long, n long, shingles binary"), "sets")
    heavy = spark.sparkContext.broadcast(common_shingles(sets))
    met = stored(clusters(sets.select("entity", "shingles").mapInArrow(_order_lists(heavy, 0), _LISTS)), "clusters")
    again = sets.join(_small(met), "entity").select("entity", "cluster", "shingles")
    met = stored(clusters(again.mapInArrow(_order_lists(heavy, 1), _LISTS)), "clusters")
    placed = in_blocks(sets, met)
    links = verified_links(sets, placed.where("blocks = 1"))
    large = placed.where("blocks > 1").select("entity", "cluster")
    if not large.isEmpty():
        again = sets.join(_small(large), "entity")
        met = stored(clusters(rarest_lists(again)), "clusters")
        links = links.unionByName(verified_links(sets, in_blocks(sets, met)))
    roots = components(links)
    whole = entities.join(roots, entities.entity == roots.node, "left").select(
        *identity, "doc_id", F.coalesce("root", "entity").alias("root")
    )
    named = whole.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = whole.join(named, "root").select(*identity, "component_id", "root")
    found = described.select("doc_id", "text_hash", "n_shingles", *identity)
    return (
        found.where("n_shingles > 0").join(labels, identity, "left").select("doc_id", "text_hash", "n_shingles", "component_id", "root")
        .unionByName(found.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root")))
    )


def _to_settle(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, stays): documents of which rows go: ``stays`` if one of several rows is left, else none is.

    A document that is one row and the first of its component, or without words, is not listed.
    """
    key = ["doc_id", "text_hash"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key)).alias("k")
    kept = found.where("root is not null").groupBy("root").agg(first).select("k.doc_id", "k.text_hash").unionByName(
        found.where("root is null").select(*key)
    )
    every = found.select(*key, F.lit(1).alias("n"), F.lit(False).alias("stays")).unionByName(
        kept.select(*key, F.lit(0).alias("n"), F.lit(True).alias("stays"))
    )
    return every.groupBy(*key).agg(F.sum("n").alias("n"), F.max("stays").alias("stays")).where("not stays or n > 1").drop("n")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component; columns as in ``docs``, whatever their names.

    Rows with equal id and text are one document, of which one row stays, also where other columns differ.
    Documents without words are kept. A null id counts as larger than any other.

    Whole rows meet the keys of what goes, not of what stays: these are fewer, and while they are few the rows stay where they
    are read. Only rows that repeat a document are brought together.
    """
    key = ["doc_id", "text_hash"]
    found = stored(near_copies(docs).select(*key, "root"), "near-copies")
    settle = stored(_to_settle(found), "to-settle")
    rows = as_rows(docs, "doc_id", F.xxhash64("text").alias("text_hash")).alias("d")
    kept = rows.join(_small(settle).alias("k"), same("d", "k", key), "left_anti")
    repeated = settle.where("stays")
    if not repeated.isEmpty():
        again = rows.join(_small(repeated).alias("k"), same("d", "k", key), "left_semi")
        kept = kept.unionByName(again.dropDuplicates(key))
    return kept.select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    return near_copies(docs).select("doc_id", "n_shingles", "component_id")


#: What ``digest`` returns, by counting shared shingles of all pairs that share one.
SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
       FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
link AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r
         GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (r)
JOIN (SELECT reach.a AS r, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = reach.b GROUP BY reach.a) c USING (r)
"""
