"""Vector codes, exact search and fill-in-the-middle against plain versions, with nulls, ties, odd lengths and clashing columns."""

import hashlib
import math
import random

import numpy as np
import pytest

from conftest import SMALL
from tallymart.llm import balltree, fim, vectorcodes, vectors
from tallymart.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, v int, key int, code int, error int, shard int, block int, rank int, score int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, x, lab, *range(1, 9)) for i, x, lab in rows], VECTORS)


def vector_rows(seed, n=130, d=24):
    """Coarse values, so that distances and scores tie often; repeated rows and ids, null ids and labels, unusable vectors."""
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.randint(-6, 6) / 64 + rng.choice([0, 1 / 8192]))) for _ in range(d)], rng.choice([None, 1, 1, 1, 2]))
            for i in range(n)]
    rows += [rows[50], rows[50], (100, rows[50][1], 2), (None, rows[51][1], None), (None, rows[51][1], 3)]
    rows += [(500, None, 1), (550, [1.0, None] + [0.0] * (d - 2), 1), (600, [float("nan")] * d, 1), (650, [float("-inf")] + [0.0] * (d - 1), 1)]
    rng.shuffle(rows)
    return rows


def whole(rows, scale, multiple=1):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = -(-max((len(v) for _, v, _ in kept), default=0) // multiple) * multiple
    return [(i, v + [0] * (d - len(v)), lab) for i, v, lab in kept]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = whole(rows, 4096, parts)
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def best(p, own):
        return min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [[[] for _ in books[p]] for p in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                own = v[p * w:(p + 1) * w]
                members[p][best(p, own)[1]].append(own)
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else books[p][k] for k, m in enumerate(members[p])] for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, v, lab in kept:
        found = [best(p, v[p * w:(p + 1) * w]) for p in range(parts)]
        coded.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(s for s, _ in found)))
    return sorted([(i, code, e, sum(x[3] for x in coded if x[1] == lab), sha) for i, lab, code, e in coded], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,d", [(1, 24), (2, 13), (3, 64)])
def test_vector_codes_match_brute_force(spark, seed, d):
    rows = vector_rows(seed, 90, d)
    assert got(vectorcodes.digest(vector_frame(spark, rows))) == brute_codes(rows)


def test_vector_codes_of_few_long_and_large_vectors(spark, monkeypatch):
    few = [(3, [0.5, -0.25], 1), (1, [0.125], 1), (2, [], None), (9, [2.0 ** 27] * 9, 1), (8, [-(2.0 ** 20)] * 3, 1)]  # unbounded numbers needed
    assert got(vectorcodes.digest(vector_frame(spark, few))) == [
        (i, c, min(e, vectors.LONG), min(t, vectors.LONG), h) for i, c, e, t, h in brute_codes(few)]
    monkeypatch.setattr(vectorcodes, "BROADCAST_ROWS", 0)  # label totals in salted shares
    monkeypatch.setattr(vectorcodes, "SLICE", 7)
    rows = vector_rows(4, 60, 8)
    assert got(vectorcodes.digest(vector_frame(spark, rows))) == brute_codes(rows)
    assert got(vectorcodes.digest(vector_frame(spark, rows).where("vec_id = 500"))) == []


def test_transform_keeps_scaled_distances_and_order():
    rng = np.random.default_rng(1)
    for width in (1, 3, 8, 20):
        p = 1 << max(width - 1, 0).bit_length()
        x = rng.integers(-5000, 5000, (50, width))
        y = vectorcodes.transformed(x, p)
        assert (vectorcodes.restored(y, width) == x).all()
        assert (((y[:, None] - y[None]) ** 2).sum(-1) == p * ((x[:, None] - x[None]) ** 2).sum(-1)).all()
        functions = vectorcodes.hadamard(np.eye(p, dtype=np.int64))[:, vectorcodes.sequency_order(p)]
        assert (np.abs(np.diff(functions, axis=0)).sum(axis=0) // 2 == np.arange(p)).all()
        few = vectorcodes.transformed(rng.integers(-2, 3, (16, width)), p)  # many ties
        entry, distance = vectorcodes.nearest(y, few)
        every = ((y[:, None] - few[None]) ** 2).sum(-1)
        assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def brute_search(rows, every=50, k=5):
    kept = whole(rows, 256)
    out = []
    for a, (i, q, _) in enumerate(kept):
        if i is not None and i % every == 0:
            scored = sorted((-max(min(sum(x * y for x, y in zip(q, v)), vectors.LONG), -vectors.LONG - 1), j is None, j or 0)
                            for b, (j, v, _) in enumerate(kept) if a != b)
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_search_matches_brute_force(spark, monkeypatch, seed):
    rows = vector_rows(seed)
    frame = vector_frame(spark, rows)
    assert got(balltree.digest(frame)) == brute_search(rows)
    monkeypatch.setattr(balltree, "SHARD_BYTES", 24 * 8 * 20)  # several rounds
    monkeypatch.setattr(balltree, "BLOCK", 2)
    monkeypatch.setattr(balltree, "LEAF", 3)
    assert got(balltree.digest(frame)) == brute_search(rows)
    assert got(balltree.top_k(frame, every=7, k=3)) == brute_search(rows, 7, 3)


def test_vectors_do_not_depend_on_the_arrow_layout(spark):
    rows = vector_rows(6, 60, 8)
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert got(balltree.digest(vector_frame(spark, rows))) == brute_search(rows)
        assert got(vectorcodes.digest(vector_frame(spark, rows))) == brute_codes(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def test_search_of_few_uneven_and_large_vectors(spark):
    rows = [(0, [1.0], 1), (50, [], 1), (7, [2.0 ** 32, -1.0], 1), (100, [2.0 ** 32, 3.0], 1)]
    assert got(balltree.digest(vector_frame(spark, rows))) == brute_search(rows)
    assert got(balltree.digest(vector_frame(spark, rows[:1]))) == []
    assert got(balltree.digest(vector_frame(spark, rows).where("vec_id = 7"))) == []
    assert got(balltree.digest(vector_frame(spark, []))) == [] == got(vectorcodes.digest(vector_frame(spark, [])))


def test_ball_tree_bounds_hold_and_cut(monkeypatch):
    """No row of a node lies outside its ball; with clustered rows most leaves are never scored."""
    rng = np.random.default_rng(3)
    v = (rng.integers(-1000, 1000, (20, 16))[rng.integers(0, 20, 2000)] + rng.integers(-20, 20, (2000, 16))).astype(np.int64)
    order, centres, radii = balltree.build(v)
    assert sorted(order) == list(range(2000))
    node = 0
    for level in range(balltree.depth_of(2000) + 1):
        bounds = balltree.bounds_of(2000, level)
        for start, end in zip(bounds[:-1], bounds[1:]):
            assert (((v[order[start:end]] - centres[node]) ** 2).sum(axis=1) <= radii[node] ** 2).all()
            node += 1
    scored, plain = [], balltree.products
    monkeypatch.setattr(balltree, "products", lambda a, b: scored.append(a.shape[0] * b.shape[0]) or plain(a, b))
    q = v[:40]
    none = np.full(40, -1)
    query, place, score = balltree.search((v[order], np.arange(2000), centres, radii), q, none, np.full(40, balltree._LEAST), 5)
    assert sum(scored) < 40 * 2000 / 2
    for i in range(40):
        assert sorted(score[query == i]) == sorted(q[i] @ v.T)[-5:]


DOCS = "doc_id long, text string, n int, output string, form int, prefix_chars int, restored_sha256 int"


def fim_rows():
    texts = [None, "", "a", "héllo wörld 😀 " * 50, "x<P>y", "<S>", "<M", "<P<S", "P>>S>", "\0tab\n", "é" * (1 << 20), "b" * (3 << 20)]
    rows = [(100 * k + j, t) for k in range(4) for j, t in enumerate(texts)]
    return rows + [(None, "no id <"), (None, None), (7, "again"), (7, "again"), (-3, "negative")]


def brute_fim(doc_id, text):
    t = text or ""
    s = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(s[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    sha = hashlib.sha256(t.encode()).hexdigest()
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(t), "plain", None, None, sha, sha
    form = "spm" if h4 % 100 < 20 else "psm"
    pre, mid, suf = t[:a], t[a:b], t[b:]
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(t), form, a, b - a, hashlib.sha256(out.encode()).hexdigest(), sha


@pytest.mark.parametrize("large", ["false", "true"])
def test_fill_in_middle_matches_brute_force(spark, large):
    rows = fim_rows()
    docs = spark.createDataFrame([(i, t, 1, "o", 2, 3, 4) for i, t in rows], DOCS)
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", large)
    try:
        out = got(fim.digest(docs))
        back = fim.restore(fim.transform(docs))
        texts = sorted(((r.doc_id, r.text) for r in back.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")
    assert out == sorted((brute_fim(i, t) for i, t in rows), key=repr)
    assert {r[2] for r in out} == {"plain", "psm", "spm"}
    assert texts == sorted(((i, t or "") for i, t in rows), key=repr)
    assert got(fim.digest(docs.limit(0))) == []


def test_sentinels_across_edges_do_not_confuse():
    """Texts of sentinel characters, cut everywhere: the output still tells where its pieces are."""
    rng = random.Random(2)
    for _ in range(300):
        body = "".join(rng.choice("<PSM>") for _ in range(rng.randint(1, 9))).encode()
        if any(m in body for m in fim.SENTINELS.values()):
            continue
        view = memoryview(body)
        for a in range(len(body) + 1):
            for b in range(a, len(body) + 1):
                pieces = dict(zip(("prefix", "middle", "suffix"), fim.cut((view, 0, len(body)), [a, b])))
                for form in fim.FORMS:
                    out = fim.written(fim.arrange(pieces, form))
                    assert fim.written(fim.rearrange(memoryview(out), form)) == body


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "some text", "en", [1, 2])], "doc_id long, text string, `a b` string, list array<int>")
    made = fim.transform(docs)
    assert made.columns[:3] == ["doc_id", "a b", "list"] and fim.restore(made).first()["text"] == "some text"


def test_queries_read_whole_tables(spark):
    tables = {name: spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("embeddings", "documents")}
    rows = [tuple(r) for r in tables["embeddings"].select("vec_id", "embedding", "label").collect()]
    assert got(QUERIES["op12_ball_tree_search"](spark, SMALL)) == brute_search(rows)
    assert QUERIES["op11_vector_codes"](spark, SMALL).count() == len(whole(rows, 1))
    assert QUERIES["op13_fill_in_middle"](spark, SMALL).count() == tables["documents"].count()
