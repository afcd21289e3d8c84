"""Cases that all text operators share: Arrow layouts, names that clash, long texts, empty tables, and whole results of the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL, plan
from tallymart.llm import decontamination, jaccard, mixing, quality, recompression, sharding, suffixdedup, tokencount, urlfilter
from tallymart.llm.common import arrow_batches
from test_operators import brute_bytes, brute_jaccard, brute_words, fixture_rows, frame, got

ITEMS = "item_id long, text string, words int, t int"


@pytest.fixture(params=["false", "true"])
def layouts(spark, request):
    """Both widths of Arrow's offsets."""
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", request.param)
    yield request.param
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def test_results_do_not_depend_on_the_arrow_layout(spark, layouts):
    rows = fixture_rows(11)
    assert got(jaccard.digest(frame(spark, rows))) == brute_jaccard(rows)
    assert got(suffixdedup.digest(frame(spark, rows))) == brute_bytes(rows)
    assert got(recompression.digest(frame(spark, rows))) == brute_words(rows)
    counts = tokencount.token_counts(frame(spark, rows).coalesce(1), {bytes([b]): -1.0 for b in range(256)})
    assert sum(r.n_tokens for r in counts.collect()) == sum(len(w) for _, t, _ in rows for w in tokencount.PRETOKEN.findall((t or "").encode()))


def test_texts_longer_than_a_chunk(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(50)}" for _ in range(60))
    long = " ".join(f"w{rng.randrange(30000)}" for _ in range(220_000))
    near = long.replace("w7 ", "v7 ") + f" {passage}"
    rows = [(1, long, "s"), (2, near, "s"), (3, passage, "t"), (4, f"x {passage} y", "t"), (5, "é" * 1_200_000, "u")]
    assert len(long) > 1 << 20
    assert got(jaccard.digest(frame(spark, rows))) == brute_jaccard(rows)
    assert got(recompression.digest(frame(spark, rows))) == brute_words(rows)
    assert got(suffixdedup.digest(frame(spark, rows))) == brute_bytes(rows)
    plain = {r.doc_id: r for r in quality.digest(frame(spark, rows)).collect()}
    assert [plain[i].n_words for i in (1, 2, 3, 5)] == [220_000, 220_060, 60, 1]
    items = spark.createDataFrame([(9, passage, 1, 1)], ITEMS)
    out = {r.doc_id: (r.n_words, r.n_hit) for r in decontamination.digest(frame(spark, rows), items).collect()}
    assert out == {1: (220_000, 0), 2: (220_060, 60), 3: (60, 60), 4: (62, 60), 5: (1, 0)}


CLASHING = ["_hash", "_copy", "_bucket", "_text_hash", "_row", "row", "text_hash", "shard", "slot_", "rank", "grp", "copies", "key", "of", "at",
            "bucket", "fp", "t", "start", "n", "entity", "a.b", "select"]


def test_stages_keep_columns_of_any_name(spark):
    rows = fixture_rows(12)
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASHING)
    docs = spark.createDataFrame([(i, t, s, *[100 * (i or 0) + k for k in range(len(CLASHING))]) for i, t, s in rows], schema)
    items = spark.createDataFrame([(1, rows[14][1], 1, 1)], ITEMS)
    stages = {
        "kept": quality.kept_documents(docs, quality.POLICIES["v1"]), "one": jaccard.one_of_each(docs),
        "clean": decontamination.clean_documents(docs, items), "mixed": mixing.mixed(docs, mixing.repeating_weights((5, 2, 1))),
    }
    original = {tuple(r) for r in docs.collect()}
    for name, out in stages.items():
        found = [tuple(r) for r in out.collect()]
        assert out.columns == docs.columns and found and set(found) <= original, name
    sharded = sharding.shard_documents(docs)
    assert sorted(sharded.columns) == sorted([*docs.columns, "grown_shard", "slot"])
    places = [i for i, c in enumerate(docs.columns) if c != "shard"]
    pick = [f"`{docs.columns[i]}`" for i in places]
    assert got(sharded.select(*pick)) == sorted((tuple(r[i] for i in places) for r in docs.collect()), key=repr)


def brute_contamination(rows, items, span=10):
    windows = defaultdict(set)
    for item, text in items:
        w = decon_words(text)
        for i in range(max(len(w) - span, 0) + 1 if w else 0):
            windows[tuple(w[i:i + span])].add(item)
    out = []
    for doc_id, text, _ in rows:
        w, hit, owners = decon_words(text), set(), set()
        for t in {len(x) for x in windows}:
            for i in range(len(w) - t + 1):
                found = windows.get(tuple(w[i:i + t]))
                if found:
                    hit |= set(range(i, i + t))
                    owners |= found
        out.append((doc_id, len(w), len(hit), len(owners - {None})))
    return sorted(out, key=repr)


def decon_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(c if ord(c) > 127 or c.isalnum() else "\0" for c in lowered).split("\0") if w]


def test_decontamination_matches_brute_force(spark, monkeypatch):
    rows = fixture_rows(13)
    rng = random.Random(1)
    items = [(i, " ".join((rows[rng.randrange(len(rows))][1] or "").split()[k:k + rng.randint(1, 16)])) for i in range(40) for k in [rng.randint(0, 30)]]
    items += [(None, "word word a"), (3, None), (7, ""), (7, items[7][1])]
    frame_of_items = spark.createDataFrame([(*x, 1, 1) for x in items], ITEMS)

    def run():
        return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontamination.digest(frame(spark, rows), frame_of_items).collect()), key=repr)

    expected = brute_contamination(rows, items)
    assert any(n for *_, n in expected) and run() == expected
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)  # every side shuffled
    assert run() == expected
    clean = decontamination.clean_documents(frame(spark, rows), frame_of_items)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _, n, _ in expected if not n)


def scalar_jump(key, shards):
    """The published sequence, one key at a time."""
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


def test_jump_is_the_published_sequence(spark):
    hashes = np.random.default_rng(4).integers(0, 1 << 64, 3000, dtype=np.uint64)
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump(hashes, shards).tolist() == [scalar_jump(int(h), shards) for h in hashes]
    hashed = {r.doc_id: r.h % (1 << 64) for r in spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    for r in sharding.digest(spark.read.parquet(f"{SMALL}/documents.parquet")).collect():
        assert (r.shard, r.grown_shard) == (scalar_jump(hashed[r.doc_id], 8), scalar_jump(hashed[r.doc_id], 9))


@pytest.mark.parametrize("group", [2, 3, 7, 4096])
def test_every_level_of_the_tree_keeps_its_words(spark, group):
    """Taken and still expected words of a source stay what they were, within one document."""
    rng = random.Random(group)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "a", "a", "b", None])) for i in range(300)]
    plan = mixing.plan_mix(frame(spark, rows), mixing.repeating_weights((5, 2, 1)), group=group).collect()
    assert len(plan) == len({(i, t, s) for i, t, s in rows})
    taken, target, largest = Counter(), {}, Counter()
    for r in plan:
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
        target[r.source], largest[r.source] = r.target, max(largest[r.source], r["size"])
    for source, aim in target.items():
        assert abs(taken[source] - aim) <= largest[source] + 1e-6


def test_empty_tables_of_the_rest(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([(1, "some words here", 1, 1)], ITEMS)
    assert decontamination.digest(none, items).count() == 0 == decontamination.clean_documents(none, items).count()
    assert tokencount.token_counts(none, {bytes([b]): -1.0 for b in range(256)}).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(pages, urlfilter.rule_table(spark, urlfilter.RULES)).count() == 0


def test_pipeline_is_its_stages_by_brute_force(spark, tmp_path):
    """Every stage's decisions on its own input: what goes must go, and what is clean stays."""
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {r.doc_id: r for r in base.collect()}
    verdict = {r.doc_id: r.kept for r in quality.digest(base).collect()}
    left = [i for i in docs if verdict[i]]
    component = {i: c for i, _, c in brute_jaccard([(i, docs[i].text, "") for i in left])}
    left = [i for i in left if component[i] == i]
    hit = {i for i, _, n, _ in brute_contamination([(i, docs[i].text, "") for i in left], bench) if n}
    left = sorted(set(left) - hit)
    out = corpus_pipeline.run(spark, SMALL).collect()
    copies = Counter(r.doc_id for r in out)
    assert set(copies) <= set(left) and max(copies.values()) <= 2
    words = {i: len((docs[i].text or "").encode().split()) for i in left}
    clean = base.where(base.doc_id.isin(left))
    taken = {r.doc_id: r.taken for r in mixing.digest(clean).collect()}
    assert {i: copies.get(i, 0) * words[i] for i in left} == taken
    of_source = Counter()
    for i in left:
        of_source[docs[i].source] += words[i]
    assert set(docs[i].source for i in copies) >= {s for s, n in of_source.items() if n > 200}
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and zlib.crc32((r.text or "").encode()) == zlib.crc32((docs[r.doc_id].text or "").encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_run_of_shingles_costs_nine_bytes_however_long_the_text(spark, monkeypatch):
    """Lengths of runs are single bytes, longer runs are cut, and no shared shingle is lost in that."""
    token = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 700, dtype=np.uint64))
    owner = np.repeat(np.array([5, 9], np.uint64), [600, 100])
    sent = jaccard._by_part(token, owner, token[:0], 1).to_pydict()
    assert list(sent["counts"][0]) == [255, 255, 90, 100]
    assert np.frombuffer(sent["entities"][0], np.uint64).tolist() == [5, 5, 5, 9]
    spread = jaccard._by_part(token, owner, token[:0], 50).to_pydict()
    runs = sum(len(x) for x in spread["counts"])
    assert sum(len(x) for x in spread["entities"]) == 8 * runs and sum(sum(x) for x in spread["counts"]) == 700

    words = [f"w{i}" for i in range(900)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:880] + ["x"] * 30)), (3, " ".join(f"v{i}" for i in range(900)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(r.shared for r in jaccard.shared_shingles(docs, 3000, 3).collect())
    assert found == [876, 876]


@pytest.mark.parametrize("few", [True, False])
def test_whole_rows_are_shuffled_once_at_the_most_to_keep_one_of_each(spark, monkeypatch, few):
    """Few keys go to the rows; many meet them in one shuffle. Rows of one document come together, no other rows do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 500_000 if few else -1)
    try:
        rows = [r for r in fixture_rows(14) if r[0] != 61] + [(63, "ONE two", "t")]
        one = jaccard.one_of_each(frame(spark, rows))
        assert plan(one).split("Physical Plan")[1].count("Exchange hashpartitioning") == (0 if few else 2)  # the keys are dealt too
        component = {i: c for i, _, c in brute_jaccard(rows)}
        assert sorted(r.doc_id or 0 for r in one.collect()) == sorted(i or 0 for i in component if i is None or i == component[i])

        # equal id and text: one row, whichever; equal id alone: by their texts; a null id is last, and repeats as any other
        rows += [(7, "one two", "x"), (4, "one two", "x"), (4, "one two", "y"), (2, "", "x"), (2, None, "x"), (2, None, "y"), (64, rows[14][1], "x")]
        rows += [(64, "some other words", "x"), (None, "alone and without id", "x"), (None, "alone and without id", "y"), (None, "ONE two", "z")]
        left = jaccard.one_of_each(frame(spark, rows)).collect()
        assert {(r.doc_id, r.text, r.source) for r in left} <= set(rows)
        pairs = brute_in_places(rows)
        assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(pairs, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def brute_in_places(rows):
    """(id, text) of what is left: each wordless one, and the smallest id of each group of linked texts."""
    texts = sorted({t for _, t, _ in rows if t and t.split()})
    group = {texts[i]: c for i, _, c in brute_jaccard([(i, t, "") for i, t in enumerate(texts)])}
    first = {}
    for i, t, _ in rows:
        if t in group:
            key = (i is None, i or 0)
            if key <= first.get(group[t], (key, t))[0]:
                first[group[t]] = (key, t)
    return {(i, t) for i, t, _ in rows if t not in group} | {(None if k[0] else k[1], t) for k, t in first.values()}


def test_a_task_of_the_near_copies_gets_texts_in_small_batches(spark, monkeypatch):
    """Also where rows are long; what the session has set is as before afterwards, and a bound of its own stands."""
    key, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", spark.sparkContext.accumulator(0)
    texts = spark.range(0, 1200, 1, 1).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 1500), i -> concat(id, 'w', i))) AS text")
    describe = jaccard._describe

    def watched(batches):
        for batch in batches:
            sizes.add(batch.nbytes > 2 * jaccard.BATCH_BYTES)
            yield from describe(iter([batch]))

    monkeypatch.setattr(jaccard, "_describe", watched)
    assert texts.agg(F.sum(F.octet_length("text"))).first()[0] > 2 * jaccard.BATCH_BYTES
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.digest(texts).collect()} == {(i, 1496, i) for i in range(1200)}
    assert sizes.value == 0 and spark.conf.get(key, None) is None
    try:
        spark.conf.set(key, 1 << 20)
        with arrow_batches(spark, 1 << 22):
            assert spark.conf.get(key) == str(1 << 20)
        assert spark.conf.get(key) == str(1 << 20)
    finally:
        spark.conf.unset(key)
