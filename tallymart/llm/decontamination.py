"""Benchmark decontamination by winnowed fingerprints.

Test items and documents are cut into k-grams of words; of every ``w`` consecutive k-gram hashes the
smallest is a fingerprint. With ``k + w - 1 = t``, any shared span of ``t`` words has a fingerprint in
common at the same place. Fingerprints of test items are joined with those of the documents, and a hit is
extended to its windows of ``t`` words, whose hashes must agree as well.

All lengths of test items and the words are dealt with in one scan; only documents that share a fingerprint are read again.
The k-gram and the window are hashed apart, 64 bits each, so a false hit needs two collisions at one
place. Small sides, up to ``BROADCAST_ROWS`` rows of a few numbers, are broadcast, else both sides are
shuffled. Neither texts nor words are shuffled, unless more documents than that have a candidate.

Edge cases: an item shorter than ``t`` words, but not empty, is one window of its own length, found by
fingerprints for that length. Null texts and texts without words hit nothing and are hit by nothing.
Documents with equal id and text get equal results, one row each. Items that repeat an id count once for
it; null ids are not listed. Extra columns are ignored. Empty tables work on either side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows, ascii_lower, let, same, split_words, stored

SPAN = 10
#: Consecutive k-grams of which the smallest is kept.
WINNOW = 4
BROADCAST_ROWS = 100_000
#: ASCII characters that are no part of a word, A-Z aside, as they are lower-cased before.
_OTHERS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_OTHERS_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and characters beyond ASCII."""
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), _OTHERS, _OTHERS_RE)


def _grams(words: Column, k: int, salt: int) -> Column:
    """64-bit hashes of all k-grams in order; needs ``k`` words at least."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.lit(salt), F.slice(words, i, k)))


def fingerprints(words: Column, t: int) -> Column:
    """Array of (fp, t, start, n): a winnowed fingerprint and the n windows of ``t`` words from ``start`` on that it stands for.

    ``start`` counts from 0. Window ``i`` covers the k-grams ``i`` to ``i + w - 1``; windows in a row with
    the same smallest hash share one fingerprint.
    """
    w = min(WINNOW, t)
    k = t - w + 1

    def runs(smallest: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(smallest) - 1),
            lambda i: (i == 0) | (F.get(smallest, i) != F.get(smallest, i - 1)),
        )
        return let(firsts, lambda f: F.transform(f, lambda i, j: F.struct(
            F.get(smallest, i).alias("fp"), F.lit(t).alias("t"), i.alias("start"), (F.coalesce(F.get(f, j + 1), F.size(smallest)) - i).alias("n"),
        )))

    def winnowed(grams: Column) -> Column:
        if w == 1:
            return grams
        return F.transform(F.sequence(F.lit(1), F.size(grams) - (w - 1)), lambda i: F.array_min(F.slice(grams, i, w)))

    none = F.array().cast("array<struct<fp:bigint,t:int,start:int,n:int>>")
    return F.when(F.size(words) >= t, let(_grams(words, k, t), lambda g: let(winnowed(g), runs))).otherwise(none)


def _windows(words: Column, t: Column, start: Column) -> Column:
    """Hash of the window of ``t`` words at ``start``."""
    return F.xxhash64(-t, F.slice(words, start + 1, t))


def index(items: DataFrame, t: int = SPAN) -> tuple[DataFrame, DataFrame, list[int]]:
    """Of the test items: stored (t, fp), stored (t, window, item_id) and the lengths of windows."""
    worded = items.select("item_id", item_words(F.col("text")).alias("words")).withColumn("t", F.least(F.size("words"), F.lit(t))).where("t > 0")
    worded = stored(worded, "items")
    lengths = sorted(row[0] for row in worded.select("t").distinct().collect())
    whole = F.sequence(F.lit(0), F.size("words") - F.col("t"))
    windows = worded.select("item_id", "t", "words", F.explode(whole).alias("start")).select(
        "t", _windows(F.col("words"), F.col("t"), F.col("start")).alias("window"), "item_id").distinct()
    marks = [worded.where(F.col("t") == n).select(F.inline(fingerprints(F.col("words"), n))).select("t", "fp") for n in lengths or [t]]
    return stored(reduce(DataFrame.unionByName, marks).distinct(), "fingerprints"), stored(windows, "item-windows"), lengths


def _small(df: DataFrame) -> DataFrame:
    """``df``, a stored table of a few numbers a row, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def candidates(docs: DataFrame, marks: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, text_hash, n_words, t, start, n): runs of windows with a fingerprint of some test item, from one scan of ``docs``.

    Each row of ``docs`` has one row more, without a run, that carries its number of words; its fingerprint is a hash of
    the text, which spreads these rows and may be taken for a run without harm, as runs are verified.
    """
    word = item_words(F.col("text"))
    none = F.lit(None).cast("int")

    def entries(words: Column, text_hash: Column) -> Column:
        own = F.array(F.struct(text_hash.alias("fp"), none.alias("t"), none.alias("start"), F.size(words).alias("n")))
        return F.concat(own, *[fingerprints(words, t) for t in lengths])

    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").select(
        "doc_id", "text_hash", F.inline(let(word, lambda words: entries(words, F.col("text_hash"))))
    )
    match = (F.col("d.fp") == F.col("m.fp")) & (F.col("d.t") == F.col("m.t"))
    joined = found.alias("d").join(_small(marks).alias("m"), match, "left").where("d.t is null or m.t is not null")
    return joined.select("doc_id", "text_hash", "d.t", "start", F.col("n").cast("long").alias("n"))


def matches(docs: DataFrame, found: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, t, start, window): places where a window of a test item occurs.

    ``found`` are stored candidates. Only documents with a candidate are read again, and only windows of
    candidates are hashed: the extension of a fingerprint to a hit.
    """
    runs = stored(
        found.where("t is not null").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("t", "start", "n")).alias("runs")), "runs"
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").alias("d")
    hit = rows.join(_small(runs).alias("r"), same("d", "r", ["doc_id", "text_hash"])).select(
        "d.doc_id", "d.text_hash", item_words(F.col("text")).alias("words"), "runs"
    )

    def spread(words: Column, runs: Column) -> Column:
        return F.flatten(F.transform(runs, lambda r: F.transform(
            F.sequence(r["start"].cast("long"), r["start"] + r["n"] - 1),
            lambda i: F.struct(r["t"].alias("t"), i.cast("int").alias("start"), _windows(words, r["t"], i.cast("int")).alias("window")),
        )))

    places = hit.select("doc_id", "text_hash", F.inline(spread(F.col("words"), F.col("runs"))))
    wanted = stored(windows.select("t", "window").distinct(), "windows")
    return places.join(_small(wanted), ["t", "window"]).select("doc_id", "text_hash", "t", "start", "window").distinct()


def _covered(spans: Column) -> Column:
    """Length of the union of (start, t) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["t"]
        fresh = F.greatest(end - F.greatest(s["start"], acc["reach"]), F.lit(0))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(end, acc["reach"]).alias("reach"))

    return F.aggregate(F.array_sort(spans), zero, step)["n"]


def _owners(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, items): sorted ids of the test items that a document has windows of.

    Windows of the same items form a class, and documents with the same classes share one list of items, so what is joined
    grows with the different lists and not with occurrences times items.
    """
    key = ["doc_id", "text_hash"]
    listed = windows.where("item_id is not null").groupBy("t", "window").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")).withColumn("class", F.xxhash64("items"))
    listed = stored(listed, "window-classes")
    members = listed.select("class", "items").dropDuplicates(["class"])
    lists = hits.select(*key, "t", "window").distinct().join(_small(listed.select("t", "window", "class")), ["t", "window"]).groupBy(*key).agg(
        F.array_sort(F.collect_set("class")).alias("classes")).withColumn("list", F.xxhash64("classes"))
    lists = stored(lists, "document-classes")
    different = lists.select("list", "classes").dropDuplicates(["list"]).select("list", F.explode("classes").alias("class"))
    items = different.join(members, "class").groupBy("list").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return lists.select(*key, "list").join(stored(items, "item-lists"), "list").select(*key, "items")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit and the sorted item ids found."""
    marks, windows, lengths = index(items)
    found = stored(candidates(docs, marks, lengths), "candidates")
    hits = stored(matches(docs, found, windows), "hits")
    covered = hits.groupBy("doc_id", "text_hash").agg(_covered(F.collect_set(F.struct("start", "t"))).alias("n_hit"))
    counted = found.where("t is null").withColumnRenamed("n", "n_words").alias("d")
    joined = counted.join(covered.alias("c"), same("d", "c", ["doc_id", "text_hash"]), "left")
    joined = joined.join(_owners(hits, windows).alias("f"), same("d", "f", ["doc_id", "text_hash"]), "left")
    return joined.select(
        "d.doc_id", "d.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no test item hits, with the columns of ``docs``, whatever their names."""
    marks, windows, lengths = index(items)
    found = stored(candidates(docs, marks, lengths).where("t is not null"), "candidates")
    hit = matches(docs, found, windows).select("doc_id", "text_hash").distinct()
    rows = as_rows(docs, "doc_id", F.xxhash64("text").alias("text_hash"))
    return rows.alias("d").join(hit.alias("h"), same("d", "h", ["doc_id", "text_hash"]), "left_anti").select("row.*")


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: What ``digest`` returns, by comparing windows as text.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS t, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, t, i, array_to_string(w[i:i + t - 1], ' ') AS win
       FROM (SELECT r, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM d, (SELECT DISTINCT t FROM iw) WHERE len(w) >= t)),
h AS (SELECT r, dw.t, i, item_id FROM dw JOIN iw ON dw.t = iw.t AND dw.win = iw.win),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + t)) AS p FROM h) GROUP BY r),
f AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN f USING (r)
"""
