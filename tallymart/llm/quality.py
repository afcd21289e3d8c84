"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: the ledger keeps the measurements and one failure bit per
rule. Policies are masks over those bits, with a version; applying one, changing one or asking what
one rule alone rejects needs the ledger only, never the text again.

Everything stays inside one row: documents are neither exploded nor shuffled. Repeated 8-word windows
are compared by 64-bit hashes within one document.

Edge cases: a null or blank text has no words and fails the length rule. Measurements of repeated rows
are equal, row by row. Result columns replace input columns of the same name in ``digest``;
``kept_documents`` returns exactly the input's columns. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows, let, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]

#: Rules in bit order: the condition, on the measurements, under which a document fails.
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 20,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "many_symbols": lambda m: 100 * m["n_symbols"] > 10 * m["n_words"],
    "repeated_lines": lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"],
    "short_words": lambda m: m["word_chars"] < 2 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 20 * m["n_words"],
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A version of what counts: a document is rejected if it fails any rule of the mask."""

    version: str
    mask: int


POLICIES = {
    "base": Policy("base", BASE),
    "v1": Policy("v1", BASE | BIT["many_symbols"] | BIT["repeated_lines"]),
    "v2": Policy("v2", sum(BIT.values())),
}


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more, from the windows' hashes in text order."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, k: (
            ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        ))

    places = F.array_sort(F.transform(let(ordered, repeated), lambda x: x["i"]))
    new = lambda p: F.transform(
        p, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(p, k - 1)))
    )
    return F.aggregate(let(places, new), F.lit(0).cast("long"), lambda total, x: total + x)


def _measures(text: Column) -> Column:
    """All measurements of a text as one struct; words and windows are built once."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column, lines: Column) -> Column:
        n = F.size(w)
        starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        # Only texts with a window that occurs twice need its places.
        repeat = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))
        values = [
            n, F.length(F.array_join(w, "")), F.regexp_count(text, F.lit(SYMBOLS)),
            F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines), repeat,
        ]
        return F.struct(*[value.cast("long").alias(name) for name, value in zip(MEASURES, values)])

    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]"))
    return let(words(text), lambda w: let(worded, lambda lines: of(w, lines)))


def _entry(text: Column) -> Column:
    """Measurements and ``failed`` as one struct, so that a filter pushed to it measures each text once."""

    def judged(m: Column) -> Column:
        failed = F.lit(0)
        for name, fails in RULES.items():
            failed = failed.bitwiseOR(F.when(fails(m), BIT[name]).otherwise(0))
        return F.struct(*[m[name].alias(name) for name in MEASURES], failed.alias("failed"))

    return let(_measures(text), judged)


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with its measurements and ``failed``, one bit per failed rule."""
    added = [*MEASURES, "failed"]
    kept = [name for name in docs.columns if name not in added]
    return docs.select(*kept, _entry(F.col("text")).alias("_entry")).select(*kept, *[F.col(f"_entry.{name}") for name in added])


def rejected(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def ablation(entries: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: documents that fail it, and documents that only it rejects.

    Distinct bit patterns are counted first; policies and rules only read those counts.
    """
    patterns = entries.groupBy("failed").agg(F.count("*").alias("_n"))
    pairs = F.array(*[
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(bit).alias("bit"), F.lit(p.mask).alias("mask"))
        for p in policies for name, bit in BIT.items() if p.mask & bit
    ])
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return (
        patterns.select("failed", "_n", F.inline(pairs)).groupBy("policy", "rule")
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("_n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(hit == F.col("bit"), F.col("_n")).otherwise(0)).alias("n_only"),
        )
    )


def kept_documents(docs: DataFrame, policy: Policy) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with the columns of ``docs``."""
    return ledger(as_rows(docs, "text")).where(~rejected(policy)).select("row.*")


def digest(docs: DataFrame, policy: Policy = POLICIES["v1"]) -> DataFrame:
    return ledger(docs.select("doc_id", "text")).select(
        "doc_id", *MEASURES, "failed", rejected(POLICIES["base"]).alias("base_failed"), (~rejected(policy)).alias("kept")
    )


#: What ``digest`` returns, from the raw texts.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             regexp_extract_all(text, '[#*$%&|<>]') AS symbols FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS gram
      FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, sum(CASE WHEN before IS NULL THEN 8 ELSE least(8, i - before) END) AS n
            FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(symbols)::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             len(lines)::BIGINT AS n_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN t USING (r) LEFT JOIN covered USING (r)),
b AS (SELECT *, (n_words < 20)::INT AS b0, (100 * n_repeat_words > 30 * n_words)::INT AS b1,
             (100 * n_symbols > 10 * n_words)::INT AS b2, (100 * n_dup_lines > 30 * n_lines)::INT AS b3,
             (word_chars < 2 * n_words)::INT AS b4, (word_chars > 20 * n_words)::INT AS b5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words,
       (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5)::INT AS failed,
       b0 + b1 > 0 AS base_failed, b0 + b1 + b2 + b3 = 0 AS kept
FROM b
"""
