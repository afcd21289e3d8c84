"""URL filter: a blocked Bloom filter of listed URL prefixes in front of an exact hash join.

A rule lists a host and the start of a path; it fits URLs of that host and its subdomains whose path
starts so, and the longest fitting rule wins. Each distinct URL gives one candidate key for each
shape (host labels, path length) among the rules. The filter maps a key to one block of 512 bits and tests a few bits
there; what passes goes to an exact join with the rules, which removes false positives.

The block table is broadcast only up to ``BROADCAST_BYTES`` of filter; beyond that the candidates are
joined to it by block number. Catalyst decides how the exact join runs.

Edge cases: a URL that is null or has no ``://`` has an empty host and path and fits no rule. A URL that no
rule fits gets ``default``. Of repeated rules with different verdicts, block wins. Repeated URLs are
judged once and joined back. Extra columns are ignored. An empty rule list or table works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The rules of the registered query: verdict, host, path. Fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BLOCK_BITS = 512
BITS_PER_KEY = 12
PROBES = 6
BROADCAST_BYTES = 8 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows (rule, verdict, labels, path_len); the rule's text is its key."""
    rows = spark.createDataFrame(rules, "verdict string, host string, path string")
    return rows.select(
        F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_len"),
    ).groupBy("rule", "labels", "path_len").agg(F.max("verdict").alias("verdict"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """Bit numbers of a key inside its block, from a hash of its own."""
    mixed = F.xxhash64(F.lit("bits"), key)
    return [F.shiftrightunsigned(mixed, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(PROBES)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter: one row per used block, with its bits in words of 64."""
    bits = keys.select(_block(F.col("rule"), blocks).alias("block"), F.explode(F.array(*_bits(F.col("rule")))).alias("bit"))
    words = [
        F.bit_or(F.when(F.shiftright("bit", 6) == i, F.expr("shiftleft(1L, bit & 63)")).otherwise(F.lit(0).cast("long"))).alias(f"w{i}")
        for i in range(BLOCK_BITS // 64)
    ]
    return bits.groupBy("block").agg(*words).select("block", F.array(*[f"w{i}" for i in range(BLOCK_BITS // 64)]).alias("words"))


def possible(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates (url, key) that the filter lets pass: every listed key, and few others."""
    listed = rules.count()
    blocks = max(1, -(-listed * BITS_PER_KEY // BLOCK_BITS))
    built = bloom_blocks(rules, blocks)
    if blocks * (BLOCK_BITS // 8) <= BROADCAST_BYTES:
        built = F.broadcast(built)
    set_bits = F.lit(True)
    for i in range(PROBES):
        bit = F.col(f"_b{i}")
        word = F.get("words", F.shiftright(bit, 6))
        set_bits = set_bits & (F.call_function("shiftrightunsigned", word, bit.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1)
    numbered = candidates.withColumn("block", _block(F.col("key"), blocks)).withColumns(
        {f"_b{i}": bit for i, bit in enumerate(_bits(F.col("key")))}
    )
    return numbered.join(built, "block").where(set_bits).select(*candidates.columns)


def candidate_keys(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, key): the end of the host and start of the path for each shape of the rules.

    Shapes are as many as there are pairs of label count and path length in the rules, which the
    syntax of URLs bounds, however long the list is.
    """
    shapes = [tuple(row) for row in rules.select("labels", "path_len").distinct().collect()]
    host_, path_, labels = F.col("host"), F.col("path"), F.size(F.split("host", r"\."))
    keys = [
        F.when((labels >= n) & (F.length(path_) >= length),
               F.concat(F.substring_index(host_, ".", -n), F.substring(path_, 1, length)))
        for n, length in shapes
    ]
    listed = F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")
    return urls.select("url", F.explode(listed).alias("key"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule and verdict."""
    split = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = split.where("host <> ''").select("url", "host", "path").distinct()
    passed = possible(candidate_keys(urls, rules), rules)
    best = (
        passed.join(rules, F.col("key") == F.col("rule"))
        .groupBy("url").agg(F.max(F.struct(F.length("rule"), "labels", "rule", "verdict")).alias("best"))
        .select("url", "best.rule", "best.verdict")
    )
    return split.join(best, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


#: What ``digest`` returns, by comparing every URL with every rule.
SQL = r"""
WITH rules(verdict, rhost, rpath) AS (VALUES """ + ", ".join(map(str, RULES)) + r"""),
p AS (SELECT row_number() OVER () AS r, page_id,
             translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
f AS (SELECT r, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f USING (r)
"""
