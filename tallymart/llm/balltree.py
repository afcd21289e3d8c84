"""Exact top-k by inner product: a ball tree for each shard, searched by branch and bound.

Rows are dealt into shards of a bounded size, and each shard's task builds a ball tree: halves along the line between two far
points, down to small leaves, a node keeping its centre and radius. A query q can score at most
``q.c + |q| r`` below a node. Blocks of queries descend a tree level by level, nodes that stay below the query's
current kth score drop out, and leaves are visited from the largest bound on in growing waves, each of which may raise the kth score.

Shards are searched in rounds, one, then three, then nine and so on. The kth score that a query has reached is handed to
every shard of the next round, so most of them are cut off high in the tree. A round's hits are merged with what was held:
``k`` rows a query are kept. Trees are written once. A cell of work is one shard and one block of queries; both have
bounded sizes, so memory does, whatever the number of rows.

Everything is whole numbers: products run in doubles only where no sum can reach 2^53, else as unbounded integers; centres are
rounded and radii and lengths rounded up, so a bound is never too small.

Edge cases: vectors that are null or hold a null, NaN or infinite component take no part. Vectors of different lengths
are filled with zeros at their end. Rows are told apart by place, not by id: a row that repeats an id is a query and a candidate of
its own. A null id is no query, is a candidate, and loses ties. Equal scores and ids are interchangeable. Scaled components
stop at 2^40 on either side, and a score beyond 64 bits counts as the nearest long. Extra columns are ignored. An empty
table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored
from .vectors import LONG, matrix, whole_vectors

SCALE = 256
TOP = 5
EVERY = 50
#: Bytes of vectors in a shard, and queries in a block.
SHARD_BYTES = 2 << 20
BLOCK = 4096
LEAF = 64
#: Each round searches so many times the shards of the one before.
GROWTH = 3
_LEAST = -LONG - 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, whole numbers both."""
    largest = [int(np.abs(x).max()) if x.size else 0 for x in (a, b)]
    if largest[0] * largest[1] * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(object) @ b.T.astype(object)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Length of each row, rounded up."""
    wide = x.astype(object) if x.size and int(np.abs(x).max()) ** 2 * x.shape[1] >= LONG else x.astype(np.int64)
    return np.array([isqrt(int(s)) + 1 for s in (wide * wide).sum(axis=1)], np.int64)


def depth_of(n: int) -> int:
    """Levels below the root, so that leaves hold about ``LEAF`` rows."""
    return max(-(-n // LEAF) - 1, 0).bit_length()


def bounds_of(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level start in tree order, and the end."""
    return np.arange((1 << level) + 1) * n >> level


def build(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the rows, centres, radii) of a ball tree; nodes from the root, level by level."""
    n = len(v)
    order, centres, radii = np.arange(n), [], []
    for level in range(depth_of(n) + 1):
        bounds = bounds_of(n, level)
        for start, end in zip(bounds[:-1], bounds[1:]):
            own = v[order[start:end]].astype(np.float64)
            centre = np.rint(own.mean(axis=0)) if len(own) else np.zeros(v.shape[1])
            centres.append(centre.astype(np.int64))
            away = _lengths(v[order[start:end]] - centres[-1])
            radii.append(int(away.max()) if len(away) else 0)
            if level < depth_of(n) and len(own):
                one = own[int(away.argmax())]
                other = own[int(((own - one) ** 2).sum(axis=1).argmax())]
                order[start:end] = order[start:end][np.argsort(own @ (other - one), kind="stable")]
    return order, np.array(centres, np.int64).reshape(len(radii), v.shape[1]), np.array(radii, np.int64)


def search(tree: tuple, q: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place in the tree, score) of each query's ``k`` best rows that score at least ``least``.

    ``tree`` is (vectors in tree order, rank of each row among equal scores, centres, radii); ``own`` is a query's own place or -1.
    """
    v, rank, centres, radii = tree
    n, m = len(v), len(q)
    length = _lengths(q)
    largest = max((int(np.abs(x).max()) for x in (q, v) if x.size), default=0)
    kind = np.int64 if largest ** 2 * max(q.shape[1], 1) * (n + 1) < LONG // 4 else object
    # one number for (score, rank): larger is better, and the score is the quotient
    none = _LEAST * n - 1
    if kind is np.int64:
        none = -(LONG // 2)
    tops = np.full((m, k), none, kind)
    floor = least.astype(object if kind is object else np.int64)
    alive = np.ones((m, 1), bool)
    first = 0
    for level in range(depth_of(n) + 1):
        count = 1 << level
        reach = products(q, centres[first:first + count]).astype(object if kind is object else np.int64)
        reach = reach + length[:, None].astype(reach.dtype) * radii[first:first + count].astype(reach.dtype)
        alive = (np.repeat(alive, 2, axis=1) if level else alive) & (reach >= floor[:, None])
        first += count
    bounds = bounds_of(n, depth_of(n))
    by = np.argsort(-reach, axis=1, kind="stable")
    seen, wave = 0, 1
    while seen < by.shape[1]:
        leaves = by[:, seen:seen + wave]
        row = np.arange(m)[:, None]
        kth = np.maximum(floor, np.where(tops[:, -1] > none, tops[:, -1] // n, floor))
        query, at = np.nonzero(alive[row, leaves] & (reach[row, leaves] >= kth[:, None]))
        leaf = leaves[query, at]
        order = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[order])) + 1
        for members in np.split(order, cuts) if len(order) else []:
            start, end = bounds[leaf[members[0]]], bounds[leaf[members[0]] + 1]
            who = query[members]
            score = np.maximum(np.minimum(products(q[who], v[start:end]).astype(kind), LONG), _LEAST)
            value = score * n + (n - 1 - rank[start:end]).astype(kind)
            mine = np.flatnonzero((own[who] >= start) & (own[who] < end))
            value[mine, own[who[mine]] - start] = none
            value[score < floor[who][:, None]] = none
            held = np.concatenate([tops[who], value], axis=1)
            tops[who] = -np.sort(-held, axis=1)[:, :k]
        seen, wave = seen + wave, 2 * wave
    query, at = np.nonzero(tops > none)
    found = tops[query, at]
    place = np.argsort(rank)[(n - 1 - found % n).astype(np.int64)] if n else np.zeros(0, np.int64)
    return query, place, (found // n).astype(np.int64)


_TREE = "shard long, ids array<long>, known array<long>, keys array<long>, vectors array<long>, centres array<long>, radii array<long>"


def _plant(dimension: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        v = matrix(group.column("v").combine_chunks(), dimension)
        order, centres, radii = build(v)
        ids = group.column("vec_id")
        cells = [
            ids.fill_null(0).to_numpy()[order].astype(np.int64), ids.is_valid().to_numpy()[order], group.column("key").to_numpy()[order],
            v[order], centres, radii,
        ]
        lists = [pa.ListArray.from_arrays(pa.array([0, c.size], pa.int32()), pa.array(c.ravel().astype(np.int64))) for c in cells]
        return pa.table([pa.array([group.column("shard")[0].as_py()]), *lists], [part.split()[0] for part in _TREE.split(", ")])

    return run


_HIT = "key long, query_id long, vec_id long, other long, score long"


def _explore(dimension: int, k: int) -> Callable:
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(trees) or not len(queries):
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in _HIT.split(", ")})
        tree = {c: trees.column(c).combine_chunks().flatten().to_numpy() for c in trees.column_names if c not in ("shard", "block")}
        ids, keys, radii, known = tree["ids"], tree["keys"], tree["radii"], tree["known"].astype(bool)
        v, centres = tree["vectors"].reshape(len(ids), dimension), tree["centres"].reshape(len(radii), dimension)
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((keys, ids, ~known))] = np.arange(len(ids))
        q, mine = matrix(queries.column("v").combine_chunks(), dimension), queries.column("key").to_numpy()
        sorter = np.argsort(keys)
        at = sorter[np.minimum(np.searchsorted(keys, mine, sorter=sorter), len(keys) - 1)]
        least = queries.column("kth").fill_null(_LEAST).to_numpy()
        query, place, score = search((v, rank, centres, radii), q, np.where(keys[at] == mine, at, -1), least, k)
        return pa.table([
            pa.array(mine[query]), pa.array(queries.column("query_id").to_numpy()[query]), pa.array(ids[place], mask=~known[place]),
            pa.array(keys[place]), pa.array(score),
        ], [c.split()[0] for c in _HIT.split(", ")])

    return run


def top_k(vectors: DataFrame, every: int = EVERY, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each row whose id ``every`` divides."""
    keyed = vectors.select(F.monotonically_increasing_id().alias("key"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows, dimension = whole_vectors(keyed, scale, 1, ["key", "vec_id"])
    rows = stored(rows, "search-rows")
    asks = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count_if(asks)).first()
    shards = -(-n * 8 * max(dimension, 1) // SHARD_BYTES)
    blocks = -(-n_queries // BLOCK)
    trees = stored(
        rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(max(shards, 1)))).groupBy("shard").applyInArrow(_plant(dimension), _TREE),
        "ball-trees",
    )
    queries = stored(
        rows.where(asks).select("key", F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("key"), F.lit(max(blocks, 1))).alias("block")),
        "search-queries",
    )
    best = queries.select("key", "query_id", *[F.lit(None).cast("long").alias(c) for c in ("vec_id", "other", "score", "rank")]).where(F.lit(False))
    order = W.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    start, width = 0, 1
    while start < shards and n_queries:
        end = min(start + width, shards)
        kth = best.where(F.col("rank") == k).select("key", F.col("score").alias("kth"))
        asked = queries.join(kth, "key", "left").withColumn("shard", F.explode(F.sequence(F.lit(start), F.lit(end - 1)).cast("array<long>")))
        searched = trees.where(F.col("shard").between(start, end - 1)).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
        hits = searched.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_explore(dimension, k), _HIT)
        merged = best.drop("rank").unionByName(hits).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
        best = stored(merged, "search-best")
        start, width = end, width * GROWTH
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    return top_k(vectors)


#: What ``digest`` returns, by scoring every row.
SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, w.vec_id, list_sum(list_transform(list_zip(q.c, w.c), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v w ON q.vec_id % 50 = 0 AND q.r <> w.r)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
