import pytest

from common import SF, empty_documents, odd_documents, words
from stockrecon.llm import mixing, registry
from stockrecon.sources.scratch import Shelf


def targets(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, rest, found = share * sum(sizes.values()), set(names), {}
    while rest:
        level = left / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > most * sizes[s]}
        if not over:
            return found | {s: level * weight[s] for s in rest}
        found |= {s: most * sizes[s] for s in over}
        left -= sum(found[s] for s in over)
        rest -= over
    return found


def judged(rows, texts):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(r["size"], largest.get(r.source, 0))
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 2 * r["size"]
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for t in texts)
    return sizes, taken, largest, want


def test_query_meets_targets(spark):
    rows = registry.op8_mixing(spark, SF).collect()
    texts = [r.text for r in registry.table(spark, SF, "documents").collect()]
    _, taken, largest, want = judged(rows, texts)
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= largest[source]
    again = registry.op8_mixing(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = mixing.mix(docs).collect()
    judged(rows, [r.text for r in docs.collect()])
    same = {(r.doc_id, r.copies) for r in rows if r.doc_id == 4}
    assert len(same) == 1
    assert mixing.mix(empty_documents(spark)).count() == 0


def test_excess_goes_to_the_others(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, None: 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(targets(sizes))
    assert got["a"] == 20


@pytest.mark.parametrize("block", [2, 7, 64])
def test_rounding_keeps_the_mass(spark, block):
    units = spark.range(900).selectExpr(
        "concat('s', id % 2) as source", "cast(id as string) as key",
        "cast(1 + (id * 7919) % 100 as double) as words", "0.25 + (id % 3) * 0.25 as p",
    )
    units = units.selectExpr("source", "key", "words", "cast(p as double) as p")
    up = mixing.round_pivotal(units, Shelf(spark), block=block)
    both = units.join(up, ["source", "key"]).collect()
    assert len(both) == 900
    for source in ("s0", "s1"):
        mine = [r for r in both if r.source == source]
        goal = sum(r.words * r.p for r in mine)
        assert abs(sum(r.words for r in mine if r.up) - goal) < 100


def test_chances_are_right_on_average(spark):
    """Over many seeds every unit comes up about as often as its share."""
    hits, runs = {}, 40
    for seed in range(runs):
        units = spark.createDataFrame(
            [("s", str(i), 1.0 + i % 5, 0.3) for i in range(60)],
            "source string, key string, words double, p double",
        )
        for r in mixing.round_pivotal(units, Shelf(spark), seed=1000 + 17 * seed, block=16).collect():
            hits[r.key] = hits.get(r.key, 0) + r.up
    mean = sum(hits.values()) / (runs * 60)
    assert 0.27 < mean < 0.33
    assert max(hits.values()) < 0.3 * runs + 4 * (0.21 * runs) ** 0.5


def test_expand_repeats_rows(spark):
    docs = odd_documents(spark)
    copies = mixing.mix(docs)
    out = mixing.expand(docs, copies)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in copies.collect())
