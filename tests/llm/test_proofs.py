"""Whole results of sharding, archives and the pipeline's stages against plain versions, lost rows included."""

import gzip
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import brute_jaccard, fixture_rows, frame

import corpus_pipeline
from conftest import SMALL
from tallymart.llm import quality, sharding, warc
from tallymart.llm.common import table


def scalar_jump(key, shards):
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


@pytest.mark.parametrize("shards", [1, 2, 7, 8, 9, 1000])
def test_jump_equals_the_scalar_version(shards):
    rng = random.Random(shards)
    keys = [0, 1, 2**63, 2**64 - 1, *[rng.getrandbits(64) for _ in range(2000)]]
    assert sharding.jump(np.array(keys, np.uint64), shards).tolist() == [scalar_jump(k, shards) for k in keys]


def test_digest_shards_are_those_of_the_hashed_key(spark):
    rows = frame(spark, fixture_rows(8))
    out = sorted((r.doc_id or -1, r.shard, r.grown_shard) for r in sharding.digest(rows).collect())
    hashed = [(r[0] or -1, r[1] % 2**64) for r in rows.select("doc_id", F.xxhash64("doc_id")).collect()]
    assert out == sorted((i, scalar_jump(h, 8), scalar_jump(h, 9)) for i, h in hashed)


def test_archives_name_their_originals(spark, tmp_path):
    body = "x" * 200
    rows = [(5, "http://a/first one", body), (9, "http://b", body), (9, "http://c", body + "y"), (7, None, "z" * 300), (8, "u", "z" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = {(r.page_id, r.url): r for r in warc.deduplicate(pages, str(tmp_path / "w")).collect()}
    assert read[9, "http://b"].refers_to == 5 and read[9, "http://b"].refers_to_url == "http://a/first%20one"
    assert read[8, "u"].refers_to == 7 and read[8, "u"].refers_to_url is None
    assert read[5, "http://a/first%20one"].refers_to_url is None
    text = "".join(gzip.decompress(f.read_bytes()).decode() for f in (tmp_path / "w").glob("*.gz"))
    ids = re.findall(r"WARC-Record-ID: (\S+)", text)
    assert len(set(ids)) == len(rows) and set(re.findall(r"WARC-Refers-To: (\S+)", text)) <= set(ids)
    for date in re.findall(r"WARC-Date: (\S+)", text):
        written = datetime.strptime(date, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
        assert abs(datetime.now(timezone.utc) - written) < timedelta(minutes=10)


def leaked(texts, items):
    """Which texts hold a window of an item."""
    def words(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = set()
    for item in items:
        w = words(item)
        windows |= {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(w) for w in windows}
    found = []
    for text in texts:
        w = words(text)
        found.append(any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1)))
    return found


def test_every_stage_keeps_what_it_should(spark):
    """Each stage is judged on its own input: nothing bad stays and nothing good is lost."""
    docs = table(spark, SMALL, "documents")
    source = docs.collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept").fetchall()}

    quality_kept = corpus_pipeline.quality_rules(spark, docs, SMALL).collect()
    assert quality_kept and sorted(quality_kept) == sorted(r for r in source if r.doc_id in good)

    first = defaultdict(list)
    for r, (_, _, component) in zip(quality_kept, brute_in_order([(r.doc_id, r.text, "") for r in quality_kept])):
        first[component].append(r)
    single = corpus_pipeline.near_copies(spark, spark.createDataFrame(quality_kept, docs.schema), SMALL).collect()
    assert sorted(single) == sorted(min(group) for group in first.values())

    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    clean = corpus_pipeline.decontaminate(spark, spark.createDataFrame(single, docs.schema), SMALL).collect()
    assert clean and sorted(clean) == sorted(r for r, bad in zip(single, leaked([r.text for r in single], items)) if not bad)
    assert len(clean) < len(single)

    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(clean, docs.schema), SMALL).collect()
    copies = Counter(mixed)
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    assert_near_targets(clean, mixed)

    sharded = corpus_pipeline.shard(spark, spark.createDataFrame(mixed, docs.schema), SMALL)
    assert sorted(tuple(r) for r in sharded.select(*docs.columns).collect()) == sorted(tuple(r) for r in mixed)
    slots = defaultdict(list)
    for r in sharded.select("doc_id", F.xxhash64("doc_id").alias("h"), "shard", "grown_shard", "slot").collect():
        assert (r.shard, r.grown_shard) == (scalar_jump(r.h % 2**64, 8), scalar_jump(r.h % 2**64, 9))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute_in_order(rows):
    component = {i: c for i, _, c in brute_jaccard(rows)}
    return [(i, t, component[i]) for i, t, _ in rows]


def assert_near_targets(clean, mixed):
    """Targets by weight 5, 2, 1 over the sources in order, stopped at twice a source, the excess reshared."""
    def size(row):
        return len(re.findall(r"[^\x20\x09-\x0D]+", row.text or ""))

    whole, taken, largest = Counter(), Counter(), Counter()
    for r in clean:
        whole[r.source] += size(r)
        largest[r.source] = max(largest[r.source], size(r))
    for r in mixed:
        taken[r.source] += size(r)
    order = sorted(whole, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, words = {}, set(order), 1.5 * sum(whole.values())
    while left:
        level = words / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] >= 2 * whole[s]}
        for s in full or set(left):
            target[s] = 2 * whole[s] if full else level * weight[s]
            words -= target[s]
            left.discard(s)
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
