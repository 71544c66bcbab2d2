import hashlib
import random

import pytest

from common import empty_documents, lower_ascii, odd_documents
from stockrecon.llm.exact_dedup import Trie, exact_dedup, exact_groups


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = sorted(map(tuple, exact_dedup(docs, keep="largest").collect()), key=repr)
    groups = {}
    for row in docs.collect():
        groups.setdefault(lower_ascii(row.text), []).append(row.doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert got == sorted(want, key=repr)


def test_smallest_id_and_empty_table(spark):
    docs = odd_documents(spark)
    kept = {r.keep_id for r in exact_groups(docs).collect()}
    assert 3 in kept and 4 not in kept
    assert exact_dedup(empty_documents(spark)).count() == 0


def test_group_without_ids(spark):
    docs = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    rows = exact_dedup(docs).collect()
    assert [(r.keep_id, r.group_size, r.kept) for r in rows] == [(None, 2, True)] * 2


@pytest.mark.parametrize("limit", [1, 3_000, 1 << 30])
def test_trie_spills_and_keeps_all(limit):
    rng = random.Random(limit)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(4_000)]
    trie = Trie(max, limit)
    want = {}
    for i, key in enumerate(keys):
        trie.insert(key, i if i % 7 else None, 1)
        best, n = want.get(key, (None, 0))
        want[key] = (i if i % 7 else best, n + 1)
    got = list(trie.items())
    assert len(got) == len(want)
    assert {k: (b, n) for k, b, n in got} == want
    assert limit > 3_000 or len(want) > 100


def test_small_tries_on_spark(spark):
    docs = odd_documents(spark)
    whole = sorted(map(repr, exact_dedup(docs).collect()))
    assert sorted(map(repr, exact_dedup(docs, trie_bytes=500).collect())) == whole
