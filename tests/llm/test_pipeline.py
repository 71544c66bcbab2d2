"""The five stages against plain Python on the small tables."""

import hashlib

import pytest

import corpus_pipeline
from common import lower_ascii, odd_documents, small_copy
from stockrecon.llm import bpe, mixing, quality, registry
from test_mixing import targets
from test_simhash import classes, fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return small_copy(spark, str(tmp_path_factory.mktemp("tables")), 90)


def test_stages_in_order(spark, folder):
    docs = registry.table(spark, folder, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)

    model = registry.quality_model(spark, docs, folder)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    good = stage[names[0]](spark, docs, folder)
    assert good.columns == columns
    want = {i for i in rows if scores[i] >= registry.QUALITY_THRESHOLD}
    assert {r.doc_id for r in good.collect()} == want and want

    keep = {}
    for i in sorted(want):
        keep[lower_ascii(rows[i].text)] = i
    single = stage[names[1]](spark, good, folder)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(keep.values())

    left = sorted(keep.values())
    roots = classes([fingerprint(rows[i].text) for i in left])
    least = sorted({left[r] for r in roots})
    near = stage[names[2]](spark, single, folder)
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == least

    mixed = stage[names[3]](spark, near, folder)
    assert mixed.columns == columns
    copies = {r.doc_id: r for r in mixing.mix(near).collect()}
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert r.text == rows[r.doc_id].text
    assert counts == {i: c.copies for i, c in copies.items() if c.copies}
    sizes = {}
    for c in copies.values():
        sizes[c.source] = sizes.get(c.source, 0) + c["size"]
    goal = targets(sizes)
    assert all(c.target == pytest.approx(goal[c.source]) for c in copies.values())

    final = stage[names[4]](spark, mixed, folder).collect()
    assert sorted(r.doc_id for r in final) == sorted(i for i, n in counts.items() for _ in range(n))
    with open(registry.ranks_path(), "rb") as file:
        codec = bpe.Codec(file.read())
    for r in final[:20]:
        (ids,) = codec.encode([rows[r.doc_id].text or ""])
        assert r.ids_sha256 == hashlib.sha256(codec.listed(ids)).hexdigest()


def test_run_equals_stages(spark, folder):
    docs = registry.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_odd_documents_pass_every_stage(spark, folder):
    for docs in (odd_documents(spark), odd_documents(spark).where("false")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, folder)
            assert name == corpus_pipeline.STAGES[-1][0] or out.columns == columns
            assert docs.limit(1).count() == 0 or out.count() > 0


def test_missing_and_repeated_ids_lose_no_text(spark, folder):
    """Rows are told apart where ids do not: every text stays once, whatever its id."""
    base = "completely different words stand in text number"
    texts = [f"{base} {i} " + " ".join(f"w{i}x{j}" for j in range(40)) for i in range(6)]
    rows = [
        (None, texts[0]), (None, texts[1]), (None, texts[1].upper()), (5, texts[1]),
        (7, texts[2]), (7, texts[3]), (7, texts[3]), (8, texts[4]), (9, texts[4]),
        (None, texts[5]), (None, texts[5]),
    ]
    docs = spark.createDataFrame(
        [(i, t, "en", "a", 0) for i, t in rows],
        "doc_id long, text string, lang string, source string, row_number long",
    )
    want = sorted(
        [(None, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4]),
         (None, texts[5])], key=repr,
    )
    stage = dict(corpus_pipeline.STAGES)
    single = stage["exact dedup"](spark, docs, folder)
    assert single.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in single.collect()], key=repr) == want
    near = stage["near dedup"](spark, single, folder)
    assert near.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in near.collect()], key=repr) == want
    first = stage["near dedup"](spark, docs, folder)
    ids = sorted([(r.doc_id, r.text) for r in first.collect()], key=repr)
    kept = sorted([(None, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3]),
                   (8, texts[4]), (None, texts[5])], key=repr)
    assert [i for i, _ in ids] == [i for i, _ in kept]
