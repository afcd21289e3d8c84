"""Repeats are decided by words, not by hashes: hashes made to collide change no result."""

from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from tallymart.llm import recompression, spans
from tallymart.llm.flat import word_bounds
from test_operators import brute_words, fixture_rows, frame, got


def weak(bits):
    return partial(recompression.find_runs, bits_kept=bits)


@pytest.mark.parametrize("parts", [1, 5])
def test_colliding_context_hashes_are_noticed_and_named_anew(spark, parts):
    rows = fixture_rows(21)
    docs = frame(spark, rows).repartition(parts)
    assert got(recompression.digest(docs, [weak(0), weak(1), recompression.find_runs])) == brute_words(rows)
    with pytest.raises(RuntimeError, match="no hash"):
        recompression.digest(docs, [weak(0)])


def test_collisions_across_batches_are_found_by_content(spark):
    """Each batch holds one text, so that no batch sees two contexts of a class."""
    passage = [f"w{i}" for i in range(150)]
    texts = [" ".join([f"a{i}", *passage, f"b{i}"]) for i in range(4)]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    table, name = spans.unique_texts(docs)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        for find, expected in ((weak(0), True), (recompression.find_runs, False)):
            found = spans.runs(table, find, True, recompression.fetch_words)
            marks = spans.stored(spans.classes(found, True, claims=True), "marks")
            assert marks.where(f"kind = {spans.FALSE}").isEmpty()
            assert not marks.where(f"kind = {spans.CLAIM}").isEmpty()
            assert spans.lied(table, marks, recompression.fetch_words) is expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        spans.forget(spark, name)


@pytest.mark.parametrize("hashes", [1, 3, 1 << 40])
def test_windows_are_compared_word_for_word(hashes):
    rng = np.random.default_rng(hashes)
    passage = [f"p{i}" for i in rng.integers(0, 9, 50)]
    w = [f"w{i}" for i in rng.integers(0, 2, 200)] + passage + [f"v{i}" for i in rng.integers(0, 9, 90)] + passage + ["z"] * 60
    data = np.frombuffer(" ".join(w).encode(), np.uint8)
    begins, ends, _ = word_bounds(data, np.array([0, len(data)]))
    text, at = recompression.spaced(data, begins, ends)
    size = recompression.WINDOW
    first = np.arange(len(w) - size + 1)
    content = [tuple(w[i:i + size]) for i in first]
    hit = recompression.repeated(text, at, first, np.array([hash(c) % hashes for c in content], np.uint64))
    assert hit.tolist() == [content.count(c) > 1 for c in content]
    assert hit.any() and not hit.all()


def test_contexts_keep_whole_words_whatever_the_white_space(spark):
    words = [f"w{i}" for i in range(80)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words), "\t" + "\n \x0b".join(words) + "\r", ""])], ["text"])
    got_ = recompression.fetch_words(batch, np.array([0, 0, 1]), np.array([0, 3, 3]), np.array([2, 5, 5]))
    assert got_[0].as_py() == (" ".join(words[:36]) + " ").encode()
    assert got_[1] == got_[2] and got_[1].as_py() == (" ".join(words[3:42]) + " ").encode()


def test_buckets_grow_with_the_bytes_of_texts(spark, monkeypatch):
    monkeypatch.setattr(spans, "BUCKET_BYTES", 100)
    rows = fixture_rows(22)
    table, name = spans.unique_texts(frame(spark, rows))
    try:
        size = sum(len((t or "").encode()) for _, t, _ in rows)
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert int(described["Num Buckets"]) == -(-size // 100)
    finally:
        spans.forget(spark, name)
