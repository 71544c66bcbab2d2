"""Near duplicates by SimHash, compared exactly tile by tile.

Distinct fingerprints are dealt into tiles by how many bits each quarter of them has
set: a tile is a box of such counts. Two fingerprints within the radius differ by at
most the radius in the four counts together, so a tile travels only to the tiles whose
boxes are that near. Inside a tile pair the same bound, taken over chunks, leaves out
most chunk pairs before the exclusive-or. A tile pair answers with a spanning forest
of its links, never with all of them, and the forests are joined into components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.components import connected
from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

BITS = 64
#: A quarter has 0 to 16 bits set, so there are at most 17^4 = 83,521 cells of equal counts.
QUARTERS, LEVELS = 4, 17
#: Rows of a tile, smallest and largest; in between, a 16th of all fingerprints.
TILE_ROWS = (4_096, 131_072)
_CHUNK = 64
_HASHES = 1 << 17


def _set_bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set, for the runs of hashes that begin at ``starts``."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _shingle_hashes(text: bytes, words: int, seed: int) -> list[int]:
    parts = text.lower().split()
    if not parts:
        return []
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), seed)]
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[i:j], seed)
        for i, j in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    ]


def fingerprints_of(texts, words: int, seed: int) -> np.ndarray:
    """Signed 64-bit fingerprints of UTF-8 texts."""
    total = np.zeros((len(texts), BITS), np.int64)
    shingles = np.zeros(len(texts), np.int64)
    held: list[int] = []
    owners: list[int] = []
    starts: list[int] = []

    def flush() -> None:
        if held:
            counts = _set_bits(np.array(held, np.uint64), np.array(starts))
            np.add.at(total, np.array(owners), counts)
            held.clear(), owners.clear(), starts.clear()

    for i, text in enumerate(texts):
        hashes = _shingle_hashes(text or b"", words, seed)
        shingles[i] = len(hashes)
        for at in range(0, len(hashes), _HASHES):
            owners.append(i)
            starts.append(len(held))
            held.extend(hashes[at : at + _HASHES])
            if len(held) >= _HASHES:
                flush()
    flush()
    majority = (2 * total > shingles[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view(np.int64).ravel()


def simhash(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
    seed: int = 42,
) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` as a signed long; null text counts as empty."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = pa.array(fingerprints_of(texts, words, seed), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, fp long"
    )


def _quarters(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _arranged(values: np.ndarray):
    """Values sorted so that chunks have close bit counts, and the chunks' count ranges."""
    counts = _quarters(values)
    order = np.lexsort(counts.T)
    values, counts = values[order], counts[order]
    starts = np.arange(0, len(values), _CHUNK)
    return (
        values,
        np.minimum.reduceat(counts, starts, axis=0),
        np.maximum.reduceat(counts, starts, axis=0),
    )


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the classes of each pair; ``label`` ends with every class at its least index."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (further := label[label]).tobytes() != label.tobytes():
            label[:] = further


def tile_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Links (value, representative) that join all values within ``radius`` bits.

    ``right`` is None where a tile meets itself.
    """
    a, a_low, a_high = _arranged(left)
    b, b_low, b_high = (a, a_low, a_high) if right is None else _arranged(right)
    shift = 0 if right is None else len(a)
    label = np.arange(len(a) if right is None else len(a) + len(b))
    for k in range(len(a_low)):
        gap = np.maximum(b_low - a_high[k], 0) + np.maximum(a_low[k] - b_high, 0)
        near = np.flatnonzero(gap.sum(axis=1) <= radius)
        if right is None:
            near = near[near >= k]
        rows = a[k * _CHUNK : (k + 1) * _CHUNK, None]
        for part in range(0, len(near), 512):
            chunks = near[part : part + 512]
            index = (chunks[:, None] * _CHUNK + np.arange(_CHUNK)).ravel()
            index = index[index < len(b)]
            i, j = np.nonzero(np.bitwise_count(rows ^ b[index]) <= radius)
            _union(label, i + k * _CHUNK, index[j] + shift)
    values = a if right is None else np.concatenate((a, b))
    linked = np.flatnonzero(label != np.arange(len(label)))
    return np.stack((values[linked], values[label[linked]]), axis=1)


class Boxes:
    """Boxes of quarter counts with about as many fingerprints each as a tile has.

    ``cells`` are the counts that occur and ``sizes`` how often; ``box`` is the box of each
    cell. A cell that alone is larger than a tile is a box of several tiles.
    """

    def __init__(self, cells: np.ndarray, sizes: np.ndarray, target: int):
        self.box = np.zeros(len(cells), np.int64)
        self.radices = LEVELS ** np.arange(QUARTERS)
        low, high, tiles = [], [], []
        open_ = [np.arange(len(cells))] if len(cells) else []
        while open_:
            rows = open_.pop()
            here, n = cells[rows], int(sizes[rows].sum())
            if n > target and len(rows) > 1:
                axis, cut = self._cut(here, sizes[rows])
                below = here[:, axis] <= cut
                open_ += [rows[below], rows[~below]]
                continue
            self.box[rows] = len(low)
            low.append(here.min(axis=0))
            high.append(here.max(axis=0))
            tiles.append(-(-n // target))
        self.low = np.array(low, np.int16).reshape(-1, QUARTERS)
        self.high = np.array(high, np.int16).reshape(-1, QUARTERS)
        self.tiles = np.array(tiles, np.int64)
        self.first = np.cumsum(self.tiles) - self.tiles

    @staticmethod
    def _cut(cells: np.ndarray, sizes: np.ndarray) -> tuple[int, int]:
        """The quarter whose counts vary most, and the count that halves the rows best."""
        mean = np.average(cells, axis=0, weights=sizes)
        axis = int(np.argmax(np.average((cells - mean) ** 2, axis=0, weights=sizes)))
        counts = cells[:, axis]
        upto = np.cumsum(np.bincount(counts, weights=sizes))
        places = np.arange(counts.min(), counts.max())
        return axis, int(places[np.argmin(np.abs(upto[places] - upto[-1] / 2))])

    def lookup(self, cells: np.ndarray) -> pa.Table:
        """For each cell its box, the box's first tile and how many tiles it has."""
        return pa.table({
            "cell": pa.array(cells @ self.radices, pa.int32()),
            "box": pa.array(self.box, pa.int32()),
            "first": pa.array(self.first[self.box], pa.int32()),
            "tiles": pa.array(self.tiles[self.box], pa.int32()),
        })

    def met_by(self, box: int, radius: int) -> np.ndarray:
        """Tiles of all boxes that a fingerprint of the box can be within ``radius`` of."""
        gap = np.maximum(self.low - self.high[box], 0) + np.maximum(self.low[box] - self.high, 0)
        near = np.flatnonzero(gap.sum(axis=1) <= radius)
        n = self.tiles[near]
        return np.repeat(self.first[near] - np.cumsum(n) + n, n) + np.arange(n.sum())


def _cell() -> Column:
    """The quarter counts of ``fp`` as one number."""
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)))
        for i in range(QUARTERS)
    ]
    return sum((c * LEVELS**i for i, c in enumerate(counts)), F.lit(0)).cast("int")


def tile_pairs(fingerprints: DataFrame, *, radius: int = 4) -> DataFrame:
    """``fp, tile, other``: every distinct fingerprint with each tile that its own one meets.

    The driver sees only how many fingerprints each cell has, at most 83,521 rows whatever
    the input, and so is the table that gives a cell its tile, which is broadcast. Which
    boxes meet is found in tasks. Of random fingerprints in a thousand tiles, one travels
    to about a seventh of them, in eight thousand to a twelfth.
    """
    spark = fingerprints.sparkSession
    counted = fingerprints.groupBy(_cell().alias("cell")).count().collect()
    numbers = np.array([r["cell"] for r in counted], np.int64)
    sizes = np.array([r["count"] for r in counted], np.int64)
    cells = numbers[:, None] // LEVELS ** np.arange(QUARTERS) % LEVELS
    target = max(TILE_ROWS[0], min(TILE_ROWS[1], int(sizes.sum()) // 16))
    boxes = Boxes(cells, sizes, target)

    def meetings(batches):
        for batch in batches:
            mine = batch.column(0).to_pylist()
            others = [pa.array(boxes.met_by(box, radius), pa.int32()) for box in mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mine, pa.int32()), pa.array(others, pa.list_(pa.int32()))],
                names=["box", "others"],
            )

    met = (
        spark.range(len(boxes.low)).select(F.col("id").cast("int").alias("box"))
        .mapInArrow(meetings, "box int, others array<int>")
    )
    lookup = spark.createDataFrame(boxes.lookup(cells)) if len(cells) else spark.createDataFrame(
        [], "cell int, box int, first int, tiles int"
    )
    part = F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")).cast("int")
    return (
        fingerprints.select("fp", _cell().alias("cell")).join(F.broadcast(lookup), "cell")
        .select("fp", "box", (F.col("first") + part).alias("tile")).join(met, "box")
        .select("fp", "tile", F.explode("others").alias("other"))
    )


def near_links(fingerprints: DataFrame, shelf: Shelf, *, radius: int = 4) -> DataFrame:
    """Links ``a, b`` that span every class of distinct ``fp`` within ``radius`` bits."""
    ship_package(fingerprints.sparkSession)
    pairs = tile_pairs(fingerprints, radius=radius).select(
        "fp", "tile", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b")
    )

    def meet(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        is_a = table.column("tile").to_numpy() == a
        links = np.empty((0, 2), np.uint64)
        if a == b or (is_a.any() and not is_a.all()):
            links = tile_forest(values[is_a], None if a == b else values[~is_a], radius)
        return pa.table({"a": links[:, 0].view(np.int64), "b": links[:, 1].view(np.int64)})

    return shelf.put(pairs.groupBy("a", "b").applyInArrow(meet, "a long, b long"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
    seed: int = 42, radius: int = 4,
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest id that can be reached, the
    document's own included. Null and blank texts have fingerprint 0 and are
    linked like any other; null ids never name a class; repeated rows keep a row
    each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark)
    marked = shelf.put(simhash(docs, id_col=id_col, text_col=text_col, words=words, seed=seed))
    distinct = shelf.put(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(near_links(distinct, shelf, radius=radius), shelf)
    classes = shelf.put(
        distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )
    )
    named = shelf.put(classes.groupBy("root").agg(F.min("least").alias("component_id")))
    lookup = shelf.put(classes.join(named, "root").select("fp", "component_id"))
    # Written tables on both sides: Spark splits the rows of a frequent fingerprint.
    return marked.join(lookup, "fp").select("doc_id", "fp", "component_id")
