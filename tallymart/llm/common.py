"""Helpers shared by the text operators: tables, words, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Separators of white-space words: blank and the five controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
_SPACES_RE = r"[ \x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts lineage, outlives executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs inside send Python batches of about ``most`` bytes, unless the session has a bound of its own.

    The bound of Spark's rows alone lets a batch of texts grow to tens of megabytes, which each task holds on both sides.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key)


def as_rows(df: DataFrame, *keys) -> DataFrame:
    """Each row as one struct ``row`` beside the keys, so that no name of the caller's meets one of ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *keys)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def split_words(text: Column, separators: str, separators_re: str) -> Column:
    """Runs of other characters than ``separators``; an empty array for null or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(separators))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, separators_re))


def words(text: Column) -> Column:
    """Words between blanks, tabs and line ends; none for null."""
    return split_words(text, SPACES, _SPACES_RE)


def count_words(text: Column) -> Column:
    """Number of words without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \x09-\x0D]+")), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def same(left: str, right: str, names: list[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition
