"""Fill-in-the-middle texts over a piece table.

A text stays where Arrow put it, as an immutable buffer of bytes, and so do the sentinels. A document is a
list of descriptors (buffer, start, end) over these buffers: first one, the whole text. Cutting at two places splits it into
prefix, middle and suffix; a form arranges descriptors and sentinels by a permutation. Hashes are fed descriptor by descriptor,
so no output is put together for them; an output is written once, when it is asked for. To restore a text, the output's own buffer
is cut at its sentinels and the inverse permutation puts the pieces back.

A text that contains a sentinel keeps the plain form, and sentinels begin with ``<`` and end with ``>``, so none can
arise across an edge of a piece: the cuts of an output are unambiguous. Places are code points, counted in the
bytes. Everything happens inside a row, without a shuffle; a task holds one Arrow batch.

Edge cases: a null text is empty, an empty text is plain. A null id hashes like an empty one. Repeated rows get equal results.
Cuts at the ends or at one place give empty pieces. Other columns are kept, but for those that this module adds, which it
replaces. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Order of the pieces in an output, each behind its sentinel.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PLAIN_FROM = 90
SPM_BELOW = 20

Descriptor = tuple[memoryview, int, int]


def draws(doc_id: int | None, seed: int = 1) -> tuple[int, ...]:
    """Four 32-bit numbers that depend on the id and the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def cut(piece: Descriptor, places: list[int]) -> list[Descriptor]:
    """Split a descriptor at ascending byte places of its buffer."""
    buffer, start, end = piece
    edges = [start, *places, end]
    return [(buffer, a, b) for a, b in zip(edges[:-1], edges[1:])]


def arrange(pieces: dict[str, Descriptor], form: str) -> list[Descriptor]:
    """The descriptors of an output."""
    out = []
    for name in FORMS[form]:
        mark = SENTINELS[name]
        out += [(memoryview(mark), 0, len(mark)), pieces[name]]
    return out


def rearrange(output: memoryview, form: str) -> list[Descriptor]:
    """The descriptors of the text behind an output, over the output's buffer."""
    if form not in FORMS:
        return [(output, 0, len(output))]
    body, pieces = bytes(output), {}
    marks = [(name, body.index(SENTINELS[name])) for name in FORMS[form]]
    ends = [at for _, at in marks[1:]] + [len(body)]
    for (name, at), end in zip(marks, ends):
        pieces[name] = (output, at + len(SENTINELS[name]), end)
    return [pieces[name] for name in ("prefix", "middle", "suffix")]


def sha256_of(pieces: list[Descriptor]) -> str:
    running = hashlib.sha256()
    for buffer, start, end in pieces:
        running.update(buffer[start:end])
    return running.hexdigest()


def written(pieces: list[Descriptor]) -> bytes:
    return b"".join(buffer[start:end] for buffer, start, end in pieces)


def compose(body: memoryview, doc_id: int | None) -> tuple[int, str, int | None, int | None, list[Descriptor]]:
    """(code points, form, prefix, middle, descriptors of the output) of one text."""
    h1, h2, h3, h4 = draws(doc_id)
    data = np.frombuffer(body, np.uint8)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each code point
    n = len(heads)
    text = bytes(body)
    if not text or any(mark in text for mark in SENTINELS.values()) or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, [(body, 0, len(body))]
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    places = [int(heads[at]) if at < n else len(body) for at in (low, high)]
    pieces = dict(zip(("prefix", "middle", "suffix"), cut((body, 0, len(body)), places)))
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    return n, form, low, high - low, arrange(pieces, form)


def bodies(column: pa.Array) -> Iterator[memoryview]:
    """Each text as a view of the column's buffer; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
        yield data[start:end]


_ADDED = "n long, form string, prefix_chars long, middle_chars long"


def _transform(carried: list[str], write: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [compose(body, doc_id) for body, doc_id in zip(bodies(batch.column("text")), batch.column("doc_id").to_pylist())]
            n, form, prefix, middle, pieces = zip(*made) if made else ((),) * 5
            columns = [batch.column(c) for c in carried] + [
                pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            names = [*carried, "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
            columns.append(pa.array([sha256_of(p) for p in pieces], pa.string()))
            if write:
                names.append("output")
                columns.append(pa.array([written(p) for p in pieces], pa.binary()).cast(pa.string(), safe=False))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _restore(carried: list[str], write: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [rearrange(body, form) for body, form in zip(bodies(batch.column("output")), batch.column("form").to_pylist())]
            names, columns = [*carried, "restored_sha256"], [batch.column(c) for c in carried]
            columns.append(pa.array([sha256_of(p) for p in pieces], pa.string()))
            if write:
                names.append("text")
                columns.append(pa.array([written(p) for p in pieces], pa.binary()).cast(pa.string(), safe=False))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _kept(df: DataFrame, without: set[str]) -> tuple[list[str], str]:
    fields = [f for f in df.schema.fields if f.name not in without]
    return [f.name for f in fields], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)


def transform(docs: DataFrame, write: bool = True) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n, form, prefix_chars, middle_chars, output_sha256 and, if written, ``output``."""
    carried, schema = _kept(docs, {"text", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"})
    columns = schema + _ADDED + ", output_sha256 string" + (", output string" if write else "")
    used = dict.fromkeys([*carried, "doc_id", "text"])
    return docs.select(*[f"`{c}`" for c in used]).mapInArrow(_transform(carried, write), columns)


def restore(made: DataFrame, write: bool = True) -> DataFrame:
    """The columns of ``made`` but ``output``, and restored_sha256 and, if written, ``text``; needs ``form`` and ``output``."""
    carried, schema = _kept(made, {"output", "text", "restored_sha256"})
    columns = schema + "restored_sha256 string" + (", text string" if write else "")
    return made.mapInArrow(_restore(carried, write), columns)


def digest(docs: DataFrame) -> DataFrame:
    return restore(transform(docs.select("doc_id", "text")), write=False).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


#: What ``digest`` returns, by cutting texts.
SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
             ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
