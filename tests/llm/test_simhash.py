import random

import numpy as np
import pytest
import xxhash

from common import SF, empty_documents, lower_ascii, odd_documents, words
from stockrecon.llm import registry, simhash
from stockrecon.llm.components import connected
from stockrecon.sources.scratch import Shelf


def fingerprint(text):
    parts = words(lower_ascii(text))
    if len(parts) >= 4:
        shingles = [" ".join(parts[i : i + 4]) for i in range(len(parts) - 3)]
    else:
        shingles = [" ".join(parts)] if parts else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_by_brute_force(spark):
    docs = registry.table(spark, SF, "documents").orderBy("doc_id").collect()
    fps = [fingerprint(d.text) for d in docs]
    roots = classes(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op3_simhash(spark, SF).collect()}
    want = {d.doc_id: (f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, roots)}
    assert got == want


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = sorted(
        ((r.doc_id, r.fp & (2**64 - 1), r.component_id)
         for r in simhash.near_duplicates(docs).collect()), key=repr,
    )
    rows = docs.collect()
    fps = [fingerprint(r.text) for r in rows]
    roots = classes(fps)
    least = {}
    for r, root in zip(rows, roots):
        if r.doc_id is not None:
            least[root] = min(r.doc_id, least.get(root, r.doc_id))
    want = [(r.doc_id, f, least[root]) for r, f, root in zip(rows, fps, roots)]
    assert got == sorted(want, key=repr)
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def planted(seed, centres=40, copies=30):
    rng = random.Random(seed)
    values = {0, 1, 2**64 - 1}
    for _ in range(centres):
        value = rng.getrandbits(64)
        for _ in range(copies):
            values.add(value)
            for _ in range(rng.randint(0, 3)):
                value ^= 1 << rng.randrange(64)
    return sorted(values)


@pytest.mark.parametrize("seed", [1, 2])
def test_tiles_keep_every_link(spark, monkeypatch, seed):
    """Chains of near values over many small tiles, against all pairs."""
    monkeypatch.setattr(simhash, "TILE_ROWS", (32, 64))
    values = planted(seed)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    shelf = Shelf(spark)
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in connected(simhash.near_links(fps, shelf), shelf).collect()}
    found = {}
    for s in signed:
        found.setdefault(roots.get(s, s), set()).add(s)
    want = {}
    for s, root in zip(signed, classes(values)):
        want.setdefault(root, set()).add(s)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_boxes_hold_every_cell_and_meet_all_near_ones():
    rng = np.random.default_rng(7)
    cells = np.unique(rng.binomial(16, 0.5, (3000, 4)), axis=0)
    sizes = rng.integers(1, 40, len(cells))
    sizes[5] = 5000  # one crowded cell takes several tiles
    boxes = simhash.Boxes(cells, sizes, 200)
    inside = (cells >= boxes.low[boxes.box]) & (cells <= boxes.high[boxes.box])
    assert inside.all()
    held = np.bincount(boxes.box, weights=sizes)
    assert (held <= 200 * boxes.tiles).all() and boxes.tiles[boxes.box[5]] == 25
    for i in range(0, len(cells), 50):
        near = np.flatnonzero(np.abs(cells - cells[i]).sum(axis=1) <= 4)
        met = set(boxes.met_by(boxes.box[i], 4).tolist())
        for box in set(boxes.box[near].tolist()):
            tiles = range(boxes.first[box], boxes.first[box] + boxes.tiles[box])
            assert met.issuperset(tiles)


def test_boxes_send_a_fingerprint_to_few_tiles():
    rng = np.random.default_rng(8)
    cells, sizes = np.unique(rng.binomial(16, 0.5, (400_000, 4)), axis=0, return_counts=True)
    boxes = simhash.Boxes(cells, sizes, 400)
    total = boxes.tiles.sum()
    held = np.bincount(boxes.box, weights=sizes)
    copies = sum(n * len(boxes.met_by(box, 4)) for box, n in enumerate(held)) / held.sum()
    assert total > 1000 and copies < 0.2 * total


def test_tile_pairs_join_near_values_of_equal_and_of_crowded_counts(spark, monkeypatch):
    """Each value meets its tile once, and two near values meet in both directions."""
    monkeypatch.setattr(simhash, "TILE_ROWS", (16, 16))
    crowded = sorted({(1 << i) | (1 << j) for i in range(16) for j in range(i)})  # one cell
    fps = spark.createDataFrame([(v,) for v in [*crowded, 0, -1]], "fp long")
    rows = simhash.tile_pairs(fps).collect()
    tile = {r.fp: r.tile for r in rows}
    met = {(r.fp, r.other) for r in rows}
    assert len(met) == len(rows) and len(set(tile.values())) > 5
    for a in tile:
        for b in tile:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                assert (a, tile[b]) in met
    assert (-1, tile[0]) not in met
    assert simhash.tile_pairs(fps.limit(0)).count() == 0


def test_forest_is_small_for_a_large_group():
    rng = np.random.default_rng(3)
    group = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    forest = simhash.tile_forest(group, None, 4)
    assert len(forest) == len(group) - 1


def test_long_chain_of_components(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b").union(spark.range(1).selectExpr("900", "950"))
    roots = {r.node: r.root for r in connected(chain, Shelf(spark)).collect()}
    assert roots == {**{i: 0 for i in range(1, 301)}, 950: 900}
