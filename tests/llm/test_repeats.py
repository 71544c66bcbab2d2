import random

import numpy as np
import pyarrow as pa
import pytest

from common import empty_documents, odd_documents, tables
from stockrecon.llm import repeats
from stockrecon.llm.repeats import remove_repeats


def brute(rows, length=50):
    least = {}
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for i, body in bodies:
        if i is not None:
            for p in range(len(body) - length + 1):
                key = body[p : p + length]
                least[key] = min(i, least.get(key, i))
    out = []
    for i, body in bodies:
        gone = np.zeros(len(body), bool)
        if i is not None:
            for p in range(len(body) - length + 1):
                if least[body[p : p + length]] < i:
                    gone[p : p + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = tuple(zip(edge[::2].tolist(), edge[1::2].tolist()))
        out.append((i, len(body), spans, kept))
    return sorted(out, key=repr)


def got(df):
    return sorted(
        (
            (r.doc_id, r.n_bytes, tuple((s.first, s.past) for s in r.spans), bytes(r.kept))
            for r in df.collect()
        ),
        key=repr,
    )


def made(seed=3):
    """Passages that documents share in part, at all offsets, in few letters."""
    pick = random.Random(seed)
    passages = ["".join(pick.choice("abc é") for _ in range(n)) for n in (49, 50, 51, 66, 90, 200)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(pick.randrange(5)):
            passage = pick.choice(passages)
            cut = pick.randrange(30)
            parts.append(passage[cut:] if pick.random() < 0.4 else passage)
            parts.append("".join(pick.choice("xyz ") for _ in range(pick.randrange(60))))
        rows.append((pick.randrange(-5, 10**6) if i else 0, "".join(parts)))
    periodic = [(10**6 + i, "ab" * (100 + i) + "c") for i in range(3)]
    copies = [(2 * 10**6 + i, "The same text as a whole, and long enough to be found. " * 3)
              for i in range(9)]
    return rows + periodic + copies


@pytest.mark.parametrize("hot", [repeats.HOT, 3, 0])
def test_planted_passages(spark, hot):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert sum(len(r[2]) for r in want) > 40
    assert got(remove_repeats(docs, hot=hot)) == want


@pytest.mark.parametrize("length", [2, 17, 33])
def test_other_lengths(spark, length):
    rows = made(length)[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(remove_repeats(docs, length=length)) == brute(rows, length)


def test_portions_of_any_size():
    texts = [t.encode() for _, t in made(9)]
    whole = [(k, p + i) for k, t in enumerate(texts) for p in [0] for i in range(len(t) - 49)]
    for size in (1, 7, 100, 1 << 20):
        starts = []
        for portion in repeats._portions(texts, 50, size):
            starts += [(k, at + i) for k, at, part in portion for i in range(len(part) - 49)]
        assert sorted(starts) == whole


def test_clash_of_names_is_told_apart(monkeypatch):
    docs = np.array([1, 2, 3])
    bodies = [b"a" * 50, b"b" * 50, b"a" * 50]
    monkeypatch.setattr(repeats, "ranks", lambda data, length: np.zeros(len(data) - length + 1, np.uint64))
    body, first, last = repeats.covered(docs, bodies)
    assert (body.tolist(), first.tolist(), last.tolist()) == ([2], [0], [0])


def test_chunks_end_between_names(monkeypatch):
    body = "0123456789" * 6
    rows = [(name, doc, 0, 10 * doc, f"{name:03d}{body}".encode())
            for name in range(9) for doc in range(name % 4 + 1)]
    table = pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), repeats._SPANS.types)], schema=repeats._SPANS
    )
    want = sorted((d, 0, 10 * d, 10 * d + 63) for _, d, *_ in rows if d)
    for chunk in (1, 100, 1 << 19):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        for size in (1, 2, 5, 100):
            found = pa.Table.from_batches(repeats._resolve(50)(table.to_batches(size)))
            assert sorted(zip(*(c.to_pylist() for c in found.columns))) == want


def test_odd_rows(spark):
    docs = odd_documents(spark).where("doc_id is null or doc_id <> 8")
    docs = docs.unionByName(docs)
    shared = "This passage of more than fifty bytes is in several rows of one id."
    more = [(4, f"{shared} and an end"), (4, f"start of it, {shared}"), (None, shared),
            (5, f"{shared}!"), (99, f"<{shared}>"), (None, f"({shared})")]
    docs = docs.unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(remove_repeats(docs)) == brute(rows)
    assert remove_repeats(empty_documents(spark)).count() == 0


def test_small_table(spark):
    docs = tables(spark, "documents")
    assert got(remove_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
