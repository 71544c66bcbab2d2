import math
import random

import numpy as np
import pytest

from stockrecon.llm import topk
from stockrecon.llm.topk import SortedLists, rounds, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(vectors, asked, k):
    def scaled(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    usable = [(i, s) for i, v in vectors if i is not None and (s := scaled(v)) is not None]
    out = []
    for own, q in {i: s for i, s in usable if i in asked}.items():
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != own
        )[:k]
        out += [(own, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize(
    "size,block,first", [(5, 8192, 16), (300, 64, 16), (300, 8192, 16), (300, 16, 2), (40, 1, 1)]
)
def test_against_brute_force(spark, size, block, first):
    rng = random.Random(size)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(size)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2001, [0.1, None]), (2002, [float("nan")] * 8),
             (2003, [float("inf")] * 8), (None, [0.1] * 8), (2004, [0.0] * 8), (2005, [])]
    rows += [rows[1]]  # a repeated row
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    asked = {r[0] for r in rows if r[0] is not None and r[0] % 10 == 0}
    got = top_k(
        frame, frame.where("vec_id % 10 = 0"), candidate_block=block, query_block=16,
        first_blocks=first, growth=2,
    ).collect()
    assert sorted(map(tuple, got)) == brute(rows, asked, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [0.5], 1, "x")], SCHEMA)
    assert top_k(none, none).count() == 0
    assert top_k(some, none).count() == 0
    assert top_k(some, some).count() == 0


def test_scores_beyond_double_precision():
    vectors = np.array([[2**30, 1], [2**30, 0], [2**30, 2]] * 20)
    lists = SortedLists(np.arange(60), vectors)
    ((ids, scores),) = lists.top(np.array([2]), np.array([[2**30, 1]]), 3)
    assert list(ids) == [5, 8, 11] and set(scores) == {2**60 + 2}


def test_lists_drop_most_candidates_before_scoring():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-1000, 1000, (4000, 4))
    vectors[:20] *= 5
    lists = SortedLists(np.arange(4000), vectors)
    query = np.array([900, -800, 0, 700])
    ((ids, scores),) = lists.top(np.array([-1]), query[None, :], 10)
    assert lists._alive(np.array([-1]), query[None, :], 10).sum() < 400
    exact = vectors @ query
    best = np.lexsort((np.arange(4000), -exact))[:10]
    assert list(ids) == list(best) and list(scores) == list(exact[best])


def test_rounds_cover_every_block_once():
    assert rounds(1, 16, 16) == [(0, 0)]
    assert rounds(23, 1, 2) == [(0, 0), (1, 2), (3, 8), (9, 22)]
    for blocks in range(1, 400):
        spans = rounds(blocks, 3, 2)
        assert [b for i, j in spans for b in range(i, j + 1)] == list(range(blocks))


def test_layers_read_every_entry_once_from_both_ends():
    rng = np.random.default_rng(3)
    lists = SortedLists(np.arange(50), rng.integers(-5, 5, (50, 3)))
    steps = [lists._layer(i) for i in range(len(topk.DEPTHS))]
    both_ends = np.concatenate((lists.vectors, lists.vectors), axis=1).T
    assert (sum(new for new, *_ in steps) == both_ends).all()
    unread = [int(left.sum()) for _, left, *_ in steps]
    assert unread == sorted(unread, reverse=True) and unread[-1] == 0


def test_a_bar_leaves_only_what_comes_before_it():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-20, 20, (900, 5))
    queries = rng.integers(-20, 20, (130, 5))
    lists = SortedLists(np.arange(900), vectors)
    own = np.full(130, -1)
    free = lists.top(own, queries, 10)
    bars = np.array([scores[4] for _, scores in free])
    bar_ids = np.array([ids[4] for ids, _ in free])
    barred = lists.top(own, queries, 10, bars, bar_ids)
    for (ids, scores), (few, few_scores) in zip(free, barred):
        assert list(few) == list(ids[:4]) and list(few_scores) == list(scores[:4])
    none = np.full(130, -(2**63))
    for (ids, _), (same, _) in zip(free, lists.top(own, queries, 10, none, none)):
        assert list(ids) == list(same)


def test_later_blocks_hand_on_few_rows():
    rng = np.random.default_rng(5)
    vectors = np.repeat(rng.integers(-900, 900, (400, 8)), 20, axis=0)  # many equal scores
    order = rng.permutation(8000)
    queries = rng.integers(-900, 900, (32, 8))
    own = np.full(32, -1)
    first, second = order[:2000], order[2000:]
    tops = SortedLists(first, vectors[first]).top(own, queries, 10)
    bars = np.array([scores[9] for _, scores in tops])
    bar_ids = np.array([ids[9] for ids, _ in tops])
    handed = 0
    for at in range(0, 6000, 100):
        part = second[at : at + 100]
        lists = SortedLists(part, vectors[part])
        handed += sum(len(ids) for ids, _ in lists.top(own, queries, 10, bars, bar_ids))
    assert handed / 32 < 2 * 10 * 3  # three times as many candidates as stand behind the bar


def test_a_score_that_fits_no_long_is_an_error():
    lists = SortedLists(np.arange(30), np.full((30, 2), 2**40))
    with pytest.raises(OverflowError):
        lists.top(np.array([-1]), np.array([[2**40, 2**40]]), 10)
    ((ids, scores),) = lists.top(np.array([-1]), np.array([[2**40, -(2**40)]]), 10)
    assert list(ids) == list(range(10)) and not scores.any()
