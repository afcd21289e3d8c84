"""Text operators against brute force and SQL, with nulls, empty and repeated rows, and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from tallymart.llm import (decontamination, jaccard, mixing, quality, recompression, sharding, suffixdedup, tokencount,
                           urlfilter, warc)
from tallymart.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 7, 9) for i, t, s in rows], DOCS)


def fixture_rows(seed=1):
    """Few words, many repeats: copies, near copies, long runs of one word, blanks, nulls, equal ids."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Ab", "é", "x1", "#", "word"]
    wide = [f"w{i}" for i in range(400)]
    rows = [(None, "no id " * 40, None), (1, None, "s"), (2, "", "s"), (3, " \n\t", "t"), (4, "one two", "t"), (5, "ONE two", "u")]
    for i in range(10, 40):
        rows.append((i, " ".join(rng.choice(vocabulary[: rng.randint(1, 7)]) for _ in range(rng.randint(1, 160))), rng.choice("stu")))
    base = [rng.choice(wide) for _ in range(150)]
    for i in range(40, 52):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(wide)
        rows.append((i, " ".join(words), "near"))
    rows += [(60, rows[12][1], "s"), (61, rows[12][1], "s"), (61, rows[12][1], "s"), (62, "y " * 5000, "long")]
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain(value):
    return None if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    ours = QUERIES[name](spark, SMALL)
    theirs = con.execute(ORACLE[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert got(ours.select(*names)) == sorted((tuple(plain(v) for v in r) for r in theirs.fetchall()), key=repr)


def brute_bytes(rows, window=100):
    seen, out = set(), []
    for doc_id, text, _ in sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - window + 1):
            piece = body[i:i + window]
            if piece in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(piece)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out += [(doc_id, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())] * rows.count((doc_id, text, _))
    return sorted(out, key=repr)


def brute_words(rows, window=35):
    split = [(doc_id, (text or "").encode().split()) for doc_id, text, _ in rows]
    count = Counter(tuple(w[i:i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_and_recompression_match_brute_force(spark):
    for seed in (1, 2):
        rows = fixture_rows(seed)
        assert got(suffixdedup.digest(frame(spark, rows))) == brute_bytes(rows)
        assert got(recompression.digest(frame(spark, rows))) == brute_words(rows)


def test_blocks_compare_every_pair(spark, monkeypatch):
    from tallymart.llm import spans

    rows = fixture_rows(3)
    monkeypatch.setattr(spans, "GROUP", 4)
    assert got(recompression.digest(frame(spark, rows))) == brute_words(rows)


def brute_jaccard(rows):
    sets = []
    for _, text, _ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=repr)


def test_third_order_keeps_similar_sets_together():
    """Sets of one cluster, noisy copies of a few bases with a passage that all share: no similar pair is parted."""
    chance = np.random.default_rng(5)
    for _ in range(40):
        bases = [chance.choice(400, int(chance.integers(1, 60)), replace=False) for _ in range(4)]
        sets = []
        for _ in range(30):
            base = bases[chance.integers(4)]
            kept = base[chance.random(len(base)) < chance.choice([0.8, 0.9, 1.0])]
            sets.append(np.unique(np.concatenate([kept, [1000, 1001], chance.integers(2000, 2400, chance.integers(0, 5))])))
        token = np.concatenate(sets).astype(np.uint64)
        at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        part_of = {int(i): n for n, part in enumerate(jaccard.split_by_rarest(token, at)) for i in part}
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                shared = len(np.intersect1d(a, b))
                if 100 * shared >= 80 * (len(a) + len(b) - shared):
                    assert part_of[i] == part_of[j]


def test_jaccard_matches_brute_force(spark, monkeypatch):
    rows = fixture_rows(4)
    assert got(jaccard.digest(frame(spark, rows))) == brute_jaccard(rows)
    monkeypatch.setattr(jaccard, "GROUP_TOKENS", 300)  # clusters in blocks
    monkeypatch.setattr(jaccard, "LIST_ROWS", 1)  # lists in parts
    assert got(jaccard.digest(frame(spark, rows))) == brute_jaccard(rows)
    kept = jaccard.one_of_each(frame(spark, rows))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {c for _, n, c in brute_jaccard(rows) if n} | {1, 2, 3} | {None}


def test_mixing_meets_targets(spark):
    rows = fixture_rows(5)
    plan = mixing.digest(frame(spark, rows)).collect()
    assert sorted(map(repr, plan)) == sorted(map(repr, mixing.digest(frame(spark, rows)).collect()))  # reruns agree
    assert len(plan) == len(rows)
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").encode().split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target = 1.5 * sum(size.values()), {}
    left = dict(size)
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        full = [s for s in left if 2 * size[s] <= level * weight[s]]
        for s in full or list(left):
            target[s] = 2.0 * size[s] if full else level * weight[s]
            del left[s]
    taken, largest = Counter(), Counter()
    source_of = {(i, len((t or "").encode().split())): s for i, t, s in rows}
    for r in plan:
        s = source_of[r.doc_id, r.size]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    assert mixing.mixed(frame(spark, rows), mixing.repeating_weights((5, 2, 1))).agg(
        F.count("*")).first()[0] >= sum(1 for r in plan if r.taken)
    small_groups = mixing.plan_mix(frame(spark, rows), mixing.repeating_weights((5, 2, 1)), group=3)
    assert small_groups.where("copies < 0 or copies > 2").count() == 0


def test_jump_sharding(spark):
    rows = fixture_rows(6)
    out = sharding.digest(frame(spark, rows)).collect()
    assert len(out) == len(rows) and all(r.grown_shard in (r.shard, 8) for r in out)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)


def test_warc_round_trip(spark, tmp_path):
    body = "<p>é\r\n\r\nWARC/1.1</p>" * 20
    rows = [(3, "http://a/ b", body, 1), (1, None, body, 1), (7, "http://c", body, 1), (2, "http://d", None, 1), (4, "u", "", 1),
            (5, "u", "x" * 99, 1), (6, "u", "x" * 99, 1), (None, "n", body, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes int")
    out = {r.page_id: r for r in warc.digest(warc.deduplicate(pages, str(tmp_path / "warc"))).collect()}
    assert len(out) == len(rows)
    for page_id, _, html, _ in rows:
        payload = (html or "").encode()
        assert out[page_id].payload_bytes == len(payload) and out[page_id].payload_digest == hashlib.sha256(payload).hexdigest()
        revisit = html == body and page_id != 1
        assert (out[page_id].record_type, out[page_id].refers_to) == (("revisit", 1) if revisit else ("response", None))
    assert warc.deduplicate(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_url_rules(spark):
    rules = urlfilter.rule_table(spark, [*urlfilter.RULES, ("allow", "net", "/es/")])
    urls = [None, "nothing", "http://WWW.Example.com/en/x?y#z", "https://sub.example.com/en/", "http://x.net/es/1", "http://net/fr/",
            "http://notnet/fr/", "http://a.com", "http://a.com/", "://com/\n/q", "http://x.net/es/1"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    assert out == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        3: ("sub.example.com", "/en/", "example.com/en/", "block"), 4: ("x.net", "/es/1", "net/es/", "block"),
        5: ("net", "/fr/", "net/fr/", "block"), 6: ("notnet", "/fr/", None, "allow"), 7: ("a.com", "", None, "allow"),
        8: ("a.com", "/", "com/", "allow"), 9: ("com", "/\n/q", "com/", "allow"), 10: ("x.net", "/es/1", "net/es/", "block"),
    }


def test_decontamination_of_short_and_long_items(spark):
    items = [(1, "Alpha beta gamma"), (2, "the"), (3, None), (4, "..."), (5, " ".join(f"t{i}" for i in range(14))), (5, "alpha BETA gamma")]
    docs = [(1, "x alpha beta GAMMA y", "s"), (2, "The cat", "s"), (3, None, "s"), (4, "pre " + " ".join(f"t{i}" for i in range(2, 14)), "s"),
            (5, " ".join(f"t{i}" for i in range(9)), "s"), (1, "x alpha beta GAMMA y", "s")]
    out = decontamination.digest(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    hit = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in out.collect())
    assert hit == [(1, 5, 3, 2, True), (1, 5, 3, 2, True), (2, 2, 1, 1, True), (3, 0, 0, 0, False), (4, 13, 12, 1, True), (5, 9, 0, 0, False)]
    assert [r.doc_id for r in decontamination.clean_documents(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
            if r.doc_id not in (3, 5)] == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.digest(frame(spark, docs), none).where("contaminated").count() == 0


def test_quality_ledger_policies_and_ablation(spark):
    rows = [(1, "a b c d e f g h " * 10, "s"), (2, " ".join(f"w{i}" for i in range(30)), "s"), (3, None, "s"), (4, "x # " * 12, "s")]
    out = {r.doc_id: r for r in quality.digest(frame(spark, rows)).collect()}
    assert out[1].n_repeat_words == 80 and out[1].base_failed and out[2].kept and out[3].n_words == 0 and not out[3].kept
    table = {(r.policy, r.rule): (r.n_failed, r.n_only) for r in
             quality.ablation(quality.ledger(frame(spark, rows)), [quality.POLICIES["base"]]).collect()}
    assert table == {("base", "few_words"): (1, 1), ("base", "repeated_words"): (2, 2)}


def test_token_counts_match_plain_dynamic_programming(spark):
    pieces = {bytes([b]): -10.0 for b in range(256)} | {b"ab": -3.0, b"abc": -4.0, b" w": -2.0, b"or": -2.5, b"word": -9.0}

    def best(word):
        state = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            state.append(max(((state[s][0] + pieces[word[s:end]], state[s][1] - 1) for s in range(end) if word[s:end] in pieces)))
        return state[-1]

    rows = fixture_rows(7) + [(90, "abcabab word words\nabc", "s")]
    for r, (doc_id, text, _) in zip(tokencount.token_counts(frame(spark, rows).coalesce(1), pieces).collect(), rows):
        scored = [best(w) for w in tokencount.PRETOKEN.findall((text or "").encode())]
        assert (r.doc_id, r.n_pretokens, r.n_tokens) == (doc_id, len(scored), -sum(n for _, n in scored))
        assert r.score == pytest.approx(sum(s for s, _ in scored))


def test_empty_tables(spark):
    none = frame(spark, [])
    for digest in (suffixdedup.digest, recompression.digest, jaccard.digest, mixing.digest, sharding.digest, quality.digest):
        assert digest(none).count() == 0


def test_pipeline_decisions(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rejected = {r.doc_id for r in QUERIES["op4_quality_ledger"](spark, SMALL).where("not kept").collect()}
    leaked = {r.doc_id for r in QUERIES["op2_decontaminate"](spark, SMALL).where("contaminated").collect()}
    kept = {r.doc_id for r in out}
    assert kept and not kept & rejected and not kept & leaked and all(r.text == docs[r.doc_id].text for r in out)
    rows = [(i, docs[i].text, "") for i in kept]
    assert len({c for _, _, c in brute_jaccard(rows)}) == len(rows)
    assert max(Counter(r.doc_id for r in out).values()) <= 2
