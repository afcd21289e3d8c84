"""Mix sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents; the whole
part is taken for sure, the rest is a fractional probability. Two documents of a source trade
probability so that the expected words stay what they were, until one of the two is settled; the
other meets the next document. Groups of documents run in parallel, each leaves one unsettled
document, and these residuals meet in groups again, level by level. What a source takes differs from
its target by less than its last residual document, which is often a large one: a small partner moves little of it.

Documents meet from the largest to the smallest. Chance comes from the groups' numbers and a seed: reruns agree.

Edge cases: a null text has no words; a document without words gets the whole copies and a coin toss
for the rest. A null source is a source, ranked last. Repeated rows (same id, source and text) are
settled together, as one document of their joint size. A source without words has target 0. Empty
input gives empty output. Extra columns are ignored, or kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_rows, count_words, same, stored

#: Documents that are settled by one task call; a larger source forms more groups.
GROUP = 2048
_UNIT = "rank long, has_id boolean, doc long, text_hash long, size long, rows long, mass double, grp long, groups long, copies int, part double"


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the 0-based rank of a column with distinct values, by code point and nulls last.

    Rows are range-partitioned and each partition numbers its own; only the partitions' counts
    meet in one place.
    """
    order = F.col(column).asc_nulls_last()
    ranged = stored(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = ranged.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    place = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1
    return (
        ranged.withColumn("_place", place).join(counts.drop("count"), "_part")
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_part", "_place", "_before")
    )


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight).

    ``share`` of all words is split by weight; a target stops at ``most`` times its source, and the
    excess is split again. A common level times the weight is raised until the words fit; every
    round stops at least one more source, and usually a few rounds do.
    """
    cap = F.col("source_size") * F.lit(float(most))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        now = sources.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, cap).otherwise(0.0)).alias("words"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if now["n"] == stopped:
            break
        stopped, level = now["n"], (share * total - now["words"]) / now["weight"] if now["weight"] else float("inf")
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _settle(group: pa.Table, seed: int) -> pa.Table:
    """Trade probability along the group; at most one document stays open, unless the group is the last of its source."""
    column = {name: group.column(name).to_numpy() for name in ("has_id", "doc", "text_hash", "mass", "part")}
    order = np.lexsort((column["doc"], ~column["has_id"], column["text_hash"], -column["mass"]))
    rank, grp, groups = (group.column(name)[0].as_py() for name in ("rank", "grp", "groups"))
    chance = np.random.default_rng([seed, rank, grp, groups]).random(2 * len(order) + 1).tolist()
    mass, part = column["mass"][order].tolist(), column["part"][order].tolist()
    copies = [-1] * len(mass)
    held = -1
    for i, (a, p) in enumerate(zip(mass, part)):
        if p <= 0.0 or p >= 1.0 or a <= 0.0:
            copies[i] = int(chance[i] < p)
            continue
        if held < 0:
            held = i
            continue
        b, q = mass[held], part[held]
        gain, loss = min((1 - q) * b, p * a), min(q * b, (1 - p) * a)  # words to, from the held document
        if chance[i] * (gain + loss) < loss:
            q, p = (1.0 if gain == (1 - q) * b else q + gain / b), (0.0 if gain == p * a else p - gain / a)
        else:
            q, p = (0.0 if loss == q * b else q - loss / b), (1.0 if loss == (1 - p) * a else p + loss / a)
        part[held], part[i] = q, p
        for j, x in ((held, q), (i, p)):
            if x <= 0.0 or x >= 1.0:
                copies[j] = int(x >= 1.0)
        held = i if copies[i] < 0 else held if copies[held] < 0 else -1
    if held >= 0 and groups == 1:
        copies[held] = int(chance[-1] < part[held])
    made = group.take(pa.array(order))
    for name, values in (("copies", pa.array(copies, pa.int32())), ("part", pa.array(part, pa.float64()))):
        made = made.set_column(made.column_names.index(name), name, values)
    return made


def _round(seed: int) -> Callable[[pa.Table], pa.Table]:
    return lambda group: _settle(group, seed)


def plan_mix(docs: DataFrame, weights: Callable[[DataFrame], DataFrame], share: float = 1.5, most: float = 2.0,
             seed: int = 7, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, source, text_hash, size, source_size, target and whole ``copies``.

    ``weights`` gets the table (source, source_size, n_docs, rank), rank from 0 by code point and null last, and returns it with a column ``weight``.
    ``most`` also bounds the copies of a document.
    """
    units = stored(
        docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), count_words(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("rows")),
        "mix-units",
    )
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n_docs")
    )
    aimed = stored(weights(numbered(sources, "source", "rank")), "mix-weights")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = stored(targets(aimed, share, most).withColumn("rate", rate), "mix-targets")
    columns = [part.split()[0] for part in _UNIT.split(", ")]
    level = units.alias("u").join(aimed.alias("s"), same("u", "s", ["source"])).select(
        "rank", F.col("doc_id").isNotNull().alias("has_id"), F.coalesce("doc_id", F.lit(0)).alias("doc"),
        "text_hash", "size", "rows", (F.col("size") * F.col("rows")).cast("double").alias("mass"),
        F.ceil(F.col("n_docs") / group).alias("groups"), F.lit(-1).alias("copies"),
        (F.col("rate") - F.floor("rate")).alias("part"),
    )
    level = level.withColumn("grp", F.pmod(F.xxhash64("doc", "text_hash"), F.col("groups")))
    width = aimed.agg(F.max(F.ceil(F.col("n_docs") / group))).first()[0] or 1
    decided = None
    for depth in range(64):
        done = level.select(*columns).groupBy("rank", "grp").applyInArrow(_round(seed + depth), _UNIT)
        done = stored(done, "mix-level")
        settled = done.where("copies >= 0")
        decided = settled if decided is None else decided.unionByName(settled)
        if width <= 1:
            break
        width = -(-width // group)
        merged = F.ceil(F.col("groups") / group)
        level = done.where("copies < 0").withColumn("groups", merged).withColumn("grp", F.col("grp") % merged)
    return decided.join(aimed, "rank").select(
        F.when(F.col("has_id"), F.col("doc")).alias("doc_id"), "source", "text_hash", "size", "rows", "source_size",
        "target", (F.floor("rate") + F.col("copies")).cast("int").alias("copies"),
    )


def repeating_weights(cycle: tuple[float, ...]) -> Callable[[DataFrame], DataFrame]:
    """Weights by the sources' order: by code point, null last, the cycle repeating."""
    values = F.array(*[F.lit(float(x)) for x in cycle])
    place = (F.col("rank") % len(cycle) + 1).cast("int")
    return lambda sources: sources.withColumn("weight", F.element_at(values, place))


def mixed(docs: DataFrame, weights: Callable[[DataFrame], DataFrame], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it."""
    plan = plan_mix(docs, weights, share, most).where("copies > 0")
    rows = as_rows(docs, "doc_id", "source", F.xxhash64("text").alias("text_hash")).alias("t")
    taken = rows.join(plan.alias("p"), same("t", "p", ["doc_id", "source", "text_hash"]))
    return taken.select("t.row", F.explode(F.sequence(F.lit(1), F.col("p.copies")))).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes of it."""
    plan = plan_mix(docs, repeating_weights((5, 2, 1)))
    return plan.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
