import os
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from common import empty_documents, odd_documents
from stockrecon.llm import quality, registry

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_held_out_accuracy(spark):
    rows = registry.op9_quality(spark, SF).collect()
    truth = {r.doc_id: r.quality for r in registry.table(spark, SF, "labels").collect()}
    assert len(rows) == registry.table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert np.mean([a for a, b in held if b == 1]) > 0.95


def labelled(spark):
    good = [(i, f"a calm and plain sentence about the river number {i}. " * 8) for i in range(80)]
    bad = [(100 + i, f"BUY!! NOW!! %%% offer {i} ||| $$$ " * 12) for i in range(80)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id < 100 as int) as quality")
    return docs, labels


def test_small_model(spark):
    docs, labels = labelled(spark)
    odd = labels.unionByName(
        spark.createDataFrame([(None, 1), (5, None), (7777, 1)], "doc_id long, quality int")
    )
    model = quality.fit(docs, odd)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(scores[i] for i in range(80)) > max(scores[100 + i] for i in range(80))
    kept = quality.keep_good(docs.withColumn("score", docs.doc_id), model, threshold=0.3)
    assert {r.doc_id for r in kept.collect()} == set(range(80))
    assert kept.columns == ["doc_id", "text", "score"]


def test_odd_documents(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels)
    rows = quality.score(odd_documents(spark), model).collect()
    assert len(rows) == odd_documents(spark).count()
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(empty) == 1
    assert quality.score(empty_documents(spark), model).count() == 0


def test_one_class_or_none(spark):
    docs, labels = labelled(spark)
    only = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.score(docs, only).collect()} == {1.0}
    none = quality.fit(docs, labels.where("quality = 9"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


def test_isotonic_pools_rise():
    at, chance = quality._isotonic(
        np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.ones(4)
    )
    assert list(at) == [0, 1.5, 3] and list(chance) == sorted(chance)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")
def test_query_against_a_plain_version(spark):
    """Size differences, calibration and scores, given the two dictionaries."""
    docs = registry.table(spark, SMALL, "documents")
    model = registry.quality_model(spark, docs, SMALL)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}

    def size(text, dictionary):
        total = 0
        for at in range(0, len(text), 1024):
            pack = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(dictionary),
                write_content_size=False, write_dict_id=False,
            )
            total += len(pack.compress(text[at : at + 1024]))
        return total

    sizes = {i: (size(t, model.good), size(t, model.bad)) for i, t in texts.items()}
    difference = {i: (b - a) / (a + b) if a else 0.0 for i, (a, b) in sizes.items()}
    labels = registry.table(spark, SMALL, "labels").where(registry.crc_class(5) != 0)
    known = labels.select(
        "doc_id", "quality", (F.xxhash64(F.lit(10), "doc_id") % 2 == 0).alias("first")
    ).collect()
    share = np.mean([r.quality for r in known])
    rest = [(difference[r.doc_id], r.quality) for r in known if not r.first and texts[r.doc_id]]
    rest.sort()
    d, y = (np.array(c, float) for c in zip(*rest))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    # The rising curve of least squares, by its max-min formula.
    n = len(y)
    mean = [[np.average(y[i : k + 1], weights=weight[i : k + 1]) for k in range(i, n)] for i in range(n)]
    fitted = [max(min(mean[i][j - i :]) for i in range(j + 1)) for j in range(n)]
    at, chance = [], []
    for value in sorted(set(np.round(fitted, 9))):
        own = np.isclose(fitted, value, atol=1e-8)
        w = weight[own].sum()
        at.append(np.average(d[own], weights=weight[own]))
        chance.append(((weight * y)[own].sum() + 0.5) / (w + 1))
    for r in registry.op9_quality(spark, SMALL).collect():
        want = np.interp(difference[r.doc_id], at, chance)
        assert r.score == pytest.approx(want, abs=1e-6)
        assert r.predicted == (r.score >= 0.3)


def test_equal_differences_are_calibrated_as_one():
    at, chance = quality._isotonic(
        np.array([1.0, 1, 1, 2, 2]), np.array([1.0, 0, 1, 0, 1]), np.ones(5)
    )
    assert list(at) == sorted(set(at)) and list(chance) == sorted(chance)


def test_rows_without_an_id(spark, tmp_path):
    docs = odd_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1), (4, 0), (None, 1)], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    rows = registry.op9_quality(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() and all(isinstance(r.held_out, bool) for r in rows)
