"""Repeated spans across a corpus: what byte-wise and word-wise removal have in common.

Every window of a fixed length has an anchor, which its own content determines, so equal windows have
equal anchors at equal places. Windows of a text that follow each other and share an anchor form a run;
the stretch that a run covers is its context. Runs of an anchor with equal contexts repeat each other
whole. Where an anchor has several contexts, these are fetched and their windows compared.

Contexts are told apart by 64-bit hashes. With ``fetch`` given, runs that claim equal contexts are held against each
other by content, inside a batch at once and across batches by ``lied``; see ``agreed``.

1. ``unique_texts``: equal texts become one row, counted, in a table bucketed by text key.
2. ``runs``: per text, runs as (anchor, context hash, place). Equal runs of a batch are combined before
   the shuffle, so the interior of a hot passage is one row per batch.
3. ``classes``: per anchor, sorted runs stream by; whole repeats become hits, contexts that compete become
   requests, and runs whose class holds others become claims.
4. ``compared``: requests fetch their contexts from the bucketed texts and are compared by anchor. Many
   anchors share a group; an anchor with many contexts is dealt into blocks that meet pair by pair.
5. ``by_text``: hits of each text are joined to it, again without moving the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import stored

#: Bytes of text in a bucket of the table of texts, beyond which it gets more buckets than shuffles have partitions.
BUCKET_BYTES = 256 << 20
#: Contexts that one group compares at once.
GROUP = 30_000
#: Bits of a packed run: its length and the anchor's place in it, both under 128.
_OFF = 128
RUN = "route long, anchor long, context long, no_id boolean, doc_id long, text_hash long, start int, packed int, flag int"
_RUN_NAMES = [part.split()[0] for part in RUN.split(", ")]
#: Flags of a run: still open; open, and known to occur elsewhere; settled as a hit; of equal hash but other content.
OPEN, KNOWN, HIT, LIED = 0, 1, 2, 3


def _combine_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by("text").aggregate([("doc_id", "min"), ([], "count_all"), ("text_hash", "min")])
        for part in table.combine_chunks().to_batches():
            yield batch_of(["doc_id", "text_hash", "copies", "text"], [
                part.column("doc_id_min"), part.column("text_hash_min"), part.column("count_all"), part.column("text"),
            ])


def unique_texts(docs: DataFrame) -> tuple[DataFrame, str]:
    """(doc_id, text_hash, copies, text), each different text once with its smallest id, and the table's name.

    Equal texts of a batch are combined before the shuffle. The table is bucketed by text_hash and lies in
    the scratch folder; its catalog entry goes with ``forget``.
    """
    spark = docs.sparkSession
    name = f"unique_texts_{uuid.uuid4().hex}"
    text = F.coalesce("text", F.lit(""))
    combined = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        _combine_texts, "doc_id long, text_hash long, copies long, text string"
    )
    size = docs.select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    texts = combined.repartition(buckets, "text_hash").groupBy("text_hash", "text").agg(
        F.min("doc_id").alias("doc_id"), F.sum("copies").alias("copies")
    )
    (
        texts.select("doc_id", "text_hash", "copies", "text").write.format("parquet").bucketBy(buckets, "text_hash")
        .option("path", scratch_dir(spark, "texts")).saveAsTable(name)
    )
    return spark.table(name), name


def forget(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _of_text(texts: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Join rows of (text_hash, no_id, key) to their text in place: only text_hash is a join key, as it is the bucket's."""
    rows = texts.withColumn("_no_id", F.col("doc_id").isNull()).withColumn("_key", F.coalesce("doc_id", F.lit(0))).alias("t")
    match = F.col("t.text_hash") == F.col("s.text_hash")
    for ours, theirs in (("t._no_id", "s.no_id"), ("t._key", "s.key")):
        match = match & (F.col(ours) <= F.col(theirs)) & (F.col(ours) >= F.col(theirs))
    return rows.join(side.alias("s"), match, how)


def batch_of(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _combine(run: dict[str, np.ndarray], everywhere: bool, contents: Callable | None = None) -> dict[str, np.ndarray]:
    """Keep one open run of each class of the batch and settle the others.

    ``everywhere``: a run counts as repeated wherever the other one lies; else only if that is earlier.
    ``contents`` gives the contexts of (rows, starts, lengths), rows ascending.
    """
    order = np.lexsort((run["start"], run["text_hash"], run["doc_id"], run["no_id"], run["context"], run["anchor"]))
    run = {name: values[order] for name, values in run.items()}
    same = np.zeros(len(order), bool)
    same[1:] = (run["anchor"][1:] == run["anchor"][:-1]) & (run["context"][1:] == run["context"][:-1])
    flag = run["flag"].copy()
    flag[same] = HIT
    if everywhere:
        firsts = np.flatnonzero(~same)
        count = np.diff(np.append(firsts, len(order)))
        flag[firsts[count > 1]] = KNOWN
        known = np.maximum.reduceat(run["flag"], firsts) == KNOWN if len(firsts) else np.zeros(0, bool)
        flag[firsts[known]] = KNOWN
    if contents is not None:
        held = same.copy()
        held[:-1] |= same[1:]
        held = np.flatnonzero(held)
        by_row = np.argsort(run["row"][held], kind="stable")
        back = np.empty(len(held), np.int64)
        back[by_row] = np.arange(len(held))
        asked = held[by_row]
        content = contents(run["row"][asked], run["start"][asked], run["packed"][asked] // _OFF).take(pa.array(back))
        differs = ~np.asarray(pc.equal(content[1:], content[:-1])) if len(held) else np.zeros(0, bool)
        flag[held[1:][differs & same[held[1:]]]] = LIED
    run["flag"] = flag
    run["route"] = np.where(flag >= HIT, run["text_hash"], run["anchor"])
    return run


def runs(texts: DataFrame, find: Callable, everywhere: bool, fetch: Callable | None = None) -> DataFrame:
    """Open and settled runs of all texts. ``find`` gets a batch's column of texts and yields, per chunk,
    (first row, row in the chunk, anchor, context, start, length, anchor's place in the run). ``fetch`` is as in
    ``compared``; with it, runs of a batch are combined only if their contexts are equal."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            no_id = np.asarray(doc.is_null())
            doc_id = doc.fill_null(0).to_numpy()
            text_hash = batch.column("text_hash").to_numpy()
            copies = batch.column("copies").to_numpy()
            parts = list(find(batch))
            if not parts:
                continue
            row = np.concatenate([first + rows for first, rows, *_ in parts])
            anchor, context, start, length, off = (np.concatenate([p[i] for p in parts]) for i in range(2, 7))
            run = _combine({
                "anchor": anchor.view(np.int64), "context": context.view(np.int64), "no_id": no_id[row], "doc_id": doc_id[row],
                "text_hash": text_hash[row], "start": start.astype(np.int32), "packed": (length * _OFF + off).astype(np.int32),
                "flag": np.where(everywhere & (copies[row] > 1), KNOWN, OPEN).astype(np.int32), "row": row,
            }, everywhere, None if fetch is None else partial(fetch, batch))
            yield batch_of(_RUN_NAMES, [run[name] for name in _RUN_NAMES])

    return texts.mapInArrow(of_batches, RUN)


#: Kinds of marks: a hit; a request; a hit that rests on a hash; the run it was held against; a hash that lied.
SETTLED, REQUEST, CLAIM, FIRST, FALSE = range(5)
_MARK = "kind int, anchor long, context long, no_id boolean, doc_id long, text_hash long, start int, packed int"
_MARK_NAMES = [part.split()[0] for part in _MARK.split(", ")]


def classes(found: DataFrame, everywhere: bool, claims: bool = False) -> DataFrame:
    """Marks from sorted runs, as a stream: of each anchor only its last run is held. With ``claims``, hits that rest
    on a hash are told from others."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            done, held = _classify(batch, everywhere, claims, last=False)
            yield done
        if held is not None:
            yield _classify(held, everywhere, claims, last=True)[0]

    ordered = found.repartition("route").sortWithinPartitions(
        "route", "anchor", "context", "no_id", "doc_id", "text_hash", "start"
    )
    return ordered.mapInArrow(stream, _MARK)


def _classify(batch: pa.RecordBatch, everywhere: bool, claims: bool, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
    """Marks of the rows that are decided, and what must wait for the next batch.

    ``flag`` of a held row carries what is known so far: its class is repeated (KNOWN), and, by 4 added,
    its anchor has an earlier context.
    """
    n = batch.num_rows
    col = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in _RUN_NAMES}
    anchor, context, flag = col["anchor"], col["context"], col["flag"]
    open_ = (flag & 3) < HIT
    rows = np.flatnonzero(open_)
    done = {SETTLED: np.flatnonzero(flag & 3 == HIT), FALSE: np.flatnonzero(flag & 3 == LIED)}
    if not len(rows):
        return _marks(col, done, claims), None
    a, c, f = anchor[rows], context[rows], flag[rows]
    new_anchor = np.ones(len(rows), bool)
    new_anchor[1:] = a[1:] != a[:-1]
    new_class = new_anchor.copy()
    new_class[1:] |= c[1:] != c[:-1]
    firsts = np.flatnonzero(new_class)
    of_class = np.cumsum(new_class) - 1
    size = np.bincount(of_class)
    repeated = (size > 1) | (np.maximum.reduceat(f & 3, firsts) == KNOWN)
    anchor_no = np.cumsum(new_anchor)[firsts] - 1
    several = (np.bincount(anchor_no) > 1) | (np.bincount(anchor_no, weights=(f[firsts] >= 4)) > 0)
    wait = np.zeros(len(firsts), bool)
    wait[-1] = not last
    hit = ~new_class | (repeated[of_class] if everywhere else False)
    ask = firsts[several[anchor_no] & ~wait]
    waiting = firsts[wait]
    hit[waiting] = False
    claim = claims & (size > 1)[of_class]
    first = np.zeros(len(rows), bool)
    first[firsts] = True
    marks = _marks(col, {
        **done, SETTLED: np.concatenate([done[SETTLED], rows[hit & ~claim]]), REQUEST: rows[ask],
        CLAIM: rows[hit & claim], FIRST: rows[first & claim & ~hit],
    }, claims)
    if last:
        return marks, None
    held = batch.slice(rows[waiting[0]], 1)
    state = (KNOWN if repeated[-1] else OPEN) + (4 if several[anchor_no[-1]] else 0)
    held = held.set_column(_RUN_NAMES.index("flag"), "flag", pa.array([state], pa.int32()))
    return marks, held


def _marks(col: dict[str, np.ndarray], of_kind: dict[int, np.ndarray], claims: bool) -> pa.RecordBatch:
    rows = np.concatenate(list(of_kind.values())).astype(int)
    kind = np.repeat(list(of_kind), [len(found) for found in of_kind.values()]).astype(np.int32)
    context = col["context"][rows] if claims else np.zeros(len(rows), np.int64)
    return batch_of(_MARK_NAMES, [kind, col["anchor"][rows], context, *[col[name][rows] for name in _MARK_NAMES[3:]]])


def _cut(texts: DataFrame, asked: DataFrame, fields: list[str], fetch: Callable, schema: str) -> DataFrame:
    """The context of each row of ``asked``, beside its ``fields`` and, where the schema has it, its text's key."""
    names = [part.split()[0] for part in schema.split(", ")]
    listed = asked.groupBy("text_hash", "no_id", F.col("doc_id").alias("key")).agg(F.collect_list(F.struct(*fields)).alias("asked"))
    joined = _of_text(texts, listed, "inner").select("s.no_id", F.col("s.key").alias("doc_id"), "s.text_hash", "asked", "text")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("asked")
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            col = {name: flat.field(i) for i, name in enumerate(fields)}
            col["content"] = fetch(batch, row, col["start"].to_numpy(), col["packed"].to_numpy() // _OFF)
            yield batch_of(names, [col[n] if n in col else batch.column(n).take(pa.array(row)) for n in names])

    return joined.mapInArrow(of_batches, schema)


def lied(texts: DataFrame, marks: DataFrame, fetch: Callable) -> bool:
    """Whether runs of equal anchor and context hash differ in content anywhere.

    A class's smallest and largest content are found with a map-side combine, so a hot class is a row per task.
    """
    if not marks.where(F.col("kind") == FALSE).isEmpty():
        return True
    fields = ["anchor", "context", "start", "packed"]
    claims = marks.where(F.col("kind").isin(CLAIM, FIRST))
    contents = _cut(texts, claims, fields, fetch, "anchor long, context long, content binary")
    ends = contents.groupBy("anchor", "context").agg(F.min("content").alias("low"), F.max("content").alias("high"))
    return not ends.where(F.col("low") != F.col("high")).isEmpty()


def agreed(texts: DataFrame, finders: Iterable[Callable], fetch: Callable, everywhere: bool) -> DataFrame:
    """Marks by the first of ``finders`` whose hashes tell all contexts apart. They differ in their hash only."""
    for find in finders:
        marks = stored(classes(runs(texts, find, everywhere, fetch), everywhere, claims=True), "marks")
        if not lied(texts, marks, fetch):
            return marks
    raise RuntimeError("no hash told all contexts apart")


_CONTEXT = "g long, block int, blocks int, anchor long, no_id boolean, doc_id long, text_hash long, start int, packed int, content binary"
_CONTEXT_NAMES = [part.split()[0] for part in _CONTEXT.split(", ")]
_HITS = "text_hash long, no_id boolean, doc_id long, start int, length int"
_HIT_NAMES = [part.split()[0] for part in _HITS.split(", ")]


def compared(texts: DataFrame, marks: DataFrame, fetch: Callable, match: Callable) -> DataFrame:
    """Hits among the contexts of requested runs, as (text_hash, no_id, doc_id, start, number of windows).

    ``fetch`` cuts contexts out of a batch of texts: for (rows, starts, lengths), rows ascending, one binary
    each. ``match`` gets a group's contexts and tells which windows are hits.
    """
    wanted = marks.where(F.col("kind") == REQUEST)
    half = GROUP // 2
    # Anchors of more than one block are few, one in half a group's contexts at most; the others need no look-up, and
    # a hot one is not shuffled by its anchor while the table is small.
    large = stored(wanted.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > half).select(
        "anchor", F.ceil(F.col("n") / half).cast("int").alias("found")
    ), "large")
    bins = wanted.count() // GROUP + 1
    single = F.col("blocks") == 1
    dealt = wanted.join(large, "anchor", "left").withColumn("blocks", F.coalesce("found", F.lit(1))).select(
        F.when(single, F.pmod(F.xxhash64("anchor"), F.lit(bins))).otherwise(F.col("anchor")).alias("g"),
        F.pmod(F.xxhash64("text_hash", "start"), F.col("blocks")).cast("int").alias("block"), "blocks",
        "anchor", "no_id", "doc_id", "text_hash", "start", "packed",
    )
    contexts = _cut(texts, dealt, ["g", "block", "blocks", "anchor", "start", "packed"], fetch, _CONTEXT)
    grouped = contexts.select(
        "*", F.explode(F.when(single, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("other")
    ).select(
        *_CONTEXT_NAMES, F.when(single, -1).otherwise(F.least("block", "other")).alias("i"),
        F.when(single, -1).otherwise(F.greatest("block", "other")).alias("j"),
    )

    def found(group: pa.Table) -> pa.Table:
        batch = group.combine_chunks().to_batches()[0]
        packed = batch.column("packed").to_numpy()
        row, first, count = match(batch, packed // _OFF, packed % _OFF)
        start = batch.column("start").to_numpy()[row] + first
        return pa.table([*[batch.column(n).take(pa.array(row)) for n in _HIT_NAMES[:3]], pa.array(start.astype(np.int32)),
                         pa.array(count.astype(np.int32))], _HIT_NAMES)

    return grouped.groupBy("g", "i", "j").applyInArrow(found, _HITS)


def consecutive(row: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, number) of stretches of hit windows."""
    order = np.lexsort((window, row))
    row, window = row[order], window[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    firsts = np.flatnonzero(new)
    return row[firsts], window[firsts], np.diff(np.append(firsts, len(row)))


def by_text(texts: DataFrame, marks: DataFrame, more: DataFrame, window: int) -> DataFrame:
    """``texts`` with ``spans``, its hits as an array of (start, end); null where it has none."""
    settled = marks.where(F.col("kind").isin(SETTLED, CLAIM)).select(
        "text_hash", "no_id", "doc_id", "start", F.floor(F.col("packed") / _OFF).cast("int").alias("length")
    )
    hits = settled.unionByName(more).groupBy("text_hash", "no_id", F.col("doc_id").alias("key")).agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("length") + (window - 1)).alias("end"))).alias("spans")
    )
    return _of_text(texts, hits, "left").select("t.doc_id", "t.text_hash", "copies", "text", "spans")


def mask(batch: pa.RecordBatch, row: int, n: int) -> np.ndarray:
    """Which of a text's n units its spans cover."""
    spans = batch.column("spans")[row]
    change = np.zeros(n + 1, np.int32)
    if spans.is_valid:
        flat = spans.values
        np.add.at(change, flat.field(0).to_numpy(), 1)
        np.add.at(change, flat.field(1).to_numpy(), -1)
    return np.cumsum(change)[:n] > 0


def of_documents(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the results of the text whose first id is theirs; ``first`` is null for later copies."""
    found = results.withColumn("first", F.lit(True)).alias("r")
    match = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_hash") == F.col("r.text_hash"))
    kept = [F.col(f"r.{name}") for name in [*results.columns, "first"] if name not in ("doc_id", "text_hash")]
    return docs.alias("d").join(found, match, "left").select("d.*", *kept)
