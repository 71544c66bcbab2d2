"""Text quality by compression.

Two zstandard dictionaries are built from good and from bad text. A text that
compresses better with the first one reads like the good examples; the
normalised difference of the two sizes is calibrated to a probability.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

#: Texts are compressed in pieces of so many bytes, each with the dictionary at hand.
PIECE_BYTES = 1024
DICTIONARY_BYTES = 110 << 10
LEVEL = 3
#: Labelled documents per class that the dictionaries and the calibration are fitted on.
FIT_ROWS = 2_000
#: Pieces per class that the dictionaries are built from.
FIT_PIECES = 4_000


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries of both classes and the curve from size difference to probability."""

    good: bytes
    bad: bytes
    at: tuple[float, ...]
    chance: tuple[float, ...]


def _pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]


@functools.lru_cache(maxsize=4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
    )


def size_difference(text: bytes, good: bytes, bad: bytes) -> float:
    """(bad - good) / (bad + good) of the compressed sizes of the whole text; 0 if empty."""
    pieces = _pieces(text)
    a = sum(len(_compressor(good).compress(p)) for p in pieces)
    b = sum(len(_compressor(bad).compress(p)) for p in pieces)
    return (b - a) / (a + b) if pieces else 0.0


def _isotonic(
    d: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Knots of the rising step curve of least squares through (d, y).

    Neighbours that would fall are pooled. Each pool stands at its mean difference
    with its share of good texts, drawn slightly to the middle.
    """
    pools: list[list[float]] = []  # weight, weight * y, weight * d
    for x, label, w in sorted(zip(d.tolist(), y.tolist(), weight.tolist())):
        pools.append([w, w * label, w * x])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return (
        tuple(p[2] / p[0] for p in pools),
        tuple((p[1] + 0.5) / (p[0] + 1.0) for p in pools),
    )


def _dictionary(pieces: list[bytes]) -> bytes:
    """Trained dictionary.

    Where there is too little text to train on, zstandard gives none; the text itself, up
    to the size of a dictionary, then serves as a raw one. This concerns the fit alone:
    every text is scored as a whole in either case.
    """
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY_BYTES]


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", fit_rows: int = FIT_ROWS, seed: int = 9,
) -> CompressionModel:
    """Fit on at most ``2 * fit_rows`` labelled documents per class, picked by a hash of the id.

    Half of them give whole texts, cut to pieces, to the dictionaries; the other
    half, with the class shares of all ``labels``, calibrates. Each dictionary is
    built from at most ``FIT_PIECES`` pieces, picked by their hash. Rows with a null id
    or label are left out; a class without any text leaves a model that scores
    every text with the share of the labels.
    """
    ship_package(docs.sparkSession)
    known = labels.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")
    ).where("id is not null and label in (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    total = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    pick = F.xxhash64(F.lit(seed), "id")
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(pick, "id").limit(2 * fit_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = chosen.select("id", "label", (F.xxhash64(F.lit(seed + 1), "id") % 2 == 0).alias("first"))
    # At most 4 * fit_rows short rows, by the limits above.
    shelf = Shelf(docs.sparkSession)
    texts = shelf.put(
        docs.select(
            F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
        ).join(F.broadcast(ids), "id")
    )

    def cut(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            found = [(label, piece) for label, text in rows for piece in _pieces(text or b"")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()),
                 pa.array([f[1] for f in found], pa.binary())],
                names=["label", "piece"],
            )

    pieces = texts.where("first").select("label", "text").mapInArrow(cut, "label int, piece binary")
    bodies = []
    for label in (1, 0):
        part = pieces.where(F.col("label") == label).orderBy(F.xxhash64("piece"), "piece")
        bodies.append([bytes(r[0]) for r in part.select("piece").limit(FIT_PIECES).collect()])
    share = total.get(1, 0) / sum(total.values()) if total else 0.5
    if not all(bodies):
        shelf.clear()
        return CompressionModel(b"", b"", (0.0,), (share,))
    good, bad = map(_dictionary, bodies)

    def measure(batches):
        for batch in batches:
            found = [
                size_difference(t or b"", good, bad)
                for t in batch.column(1).cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], names=["label", "d"]
            )

    # At most 4 * fit_rows pairs of numbers.
    pairs = (
        texts.where("not first and length(text) > 0").select("label", "text")
        .mapInArrow(measure, "label int, d double").orderBy("label", "d").collect()
    )
    shelf.clear()
    d, y = np.array([r[1] for r in pairs]), np.array([float(r[0]) for r in pairs])
    if len(set(y)) < 2:
        return CompressionModel(good, bad, (0.0,), (share,))
    # The sample holds both classes in equal number; weights restore their shares.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return CompressionModel(good, bad, *_isotonic(d, y, weight))


def _chances(texts: pa.Array, model: CompressionModel) -> pa.Array:
    d = np.array(
        [
            size_difference(t or b"", model.good, model.bad) if model.good else 0.0
            for t in texts.cast(pa.binary()).to_pylist()
        ]
    )
    return pa.array(np.interp(d, model.at, model.chance), pa.float64())


def score(
    docs: DataFrame, model: CompressionModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score`` for every row; score is the calibrated chance of label 1.

    Null and empty texts have no size difference and get the curve's value at 0.
    Repeated rows keep a row each; other columns are not read.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _chances(batch.column(1), shared.value)],
                names=["doc_id", "score"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, score double"
    )


def keep_good(
    docs: DataFrame, model: CompressionModel, *, threshold: float, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score is at least ``threshold``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = _chances(batch.column(at), shared.value)
            yield batch.filter(pc.greater_equal(found, threshold))

    return docs.mapInArrow(run, docs.schema)
