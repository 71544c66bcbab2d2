import hashlib
import os
import random

import pytest
import tiktoken

from common import empty_documents, odd_documents
from stockrecon.llm import bpe, registry

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = registry.ranks_path()


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(file.read())


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def test_random_texts(codec, reference):
    rng = random.Random(5)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "É", "1", "٣",
             "!", "?", " ", "　", "中", "😀", "'S", "x'", "\x1c", "́", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5_000)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == reference.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_code_points(codec, reference):
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    points = points[:0x3000] + random.Random(1).sample(points[0x3000:], 4_000)
    texts = [f"a{chr(p)} {chr(p)}1{chr(p)}!" for p in points]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == reference.encode_ordinary(text), hex(ord(text[1]))


def test_long_slices(codec, reference):
    text = "ab" * 40_000 + " " * 40_000 + "中" * 20_000 + "'" * 5_000 + "s"
    (ids,) = codec.encode([text])
    assert ids == reference.encode_ordinary(text)
    ends = codec.ends(ids)
    assert ends[-1] == len(text.encode())
    half = len(ids) // 2
    assert codec.decode(ids[:half]) == text.encode()[: ends[half - 1]]


def test_scan_is_independent_of_portions(monkeypatch):
    texts = ["it's a  test\n", "", "'s", " ", "don't" * 50]
    whole = list(bpe.split_texts(texts))
    monkeypatch.setattr(bpe, "SCAN_POINTS", 3)
    assert list(bpe.split_texts(texts)) == whole
    assert whole[2] == ["'s"] and whole[1] == []


def test_cache_turnover(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SLICES", 4)
    fresh = bpe.Codec(open(PATH, "rb").read())
    texts = ["Thlyouble inesea ononedth edshhe"] * 3 + ["thatnd onthin Thlyouble"]
    assert list(fresh.encode(texts)) == list(codec.encode(texts))
    assert len(fresh._recent) <= 4


def test_on_spark(spark, reference):
    docs = odd_documents(spark)
    want = []
    for row in docs.collect():
        ids = reference.encode_ordinary(row.text or "")
        want.append(
            (row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((row.text or "").encode()).hexdigest())
        )
    assert sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr) == sorted(
        want, key=repr
    )
    coded = bpe.encode(docs, PATH)
    back = {r.doc_id: bytes(r.text).decode() for r in bpe.decode(coded, PATH).collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}
    assert bpe.round_trip(empty_documents(spark), PATH).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_query_equals_tiktoken(spark, reference):
    rows = {r.doc_id: r for r in registry.op2_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = registry.table(spark, "/root/testdata/sf0.001", "documents").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = reference.encode_ordinary(doc.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (rows[doc.doc_id].n_tokens, rows[doc.doc_id].ids_sha256) == (len(ids), digest)
