"""Language by string kernels.

Two texts are as alike as the n-grams both contain, for all lengths up to three
(a blended spectrum of presence), scaled by how many each contains. N-grams are told
apart by a hash of ``HASH_BITS`` bits, which belongs to the kernel. Landmark texts
span the space (Nyström), ridge regression separates every language from the
rest, and a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

UNKNOWN = "und"
ORDERS = (1, 2, 3)
HASH_BITS = 20
#: Per language: landmark texts, and further texts for the regression.
LANDMARKS = 48
FIT_ROWS = 800
#: Over all languages: with very many of them, each gets fewer, but one at least.
ALL_LANDMARKS = 1_024
ALL_FIT_ROWS = 16_000
RIDGE = 1e-3
_POINTS = 1 << 19


@dataclass(frozen=True)
class KernelModel:
    """Weights of every known n-gram for every language, and the regression's offsets."""

    languages: tuple[str, ...]
    slots: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array(
        [unicodedata.category(chr(p))[0] == "L" for p in range(sys.maxunicode + 1)]
    )


def _grams(texts: list[str], points_at_once: int = _POINTS):
    """Hashed n-grams of each text, in portions: (text numbers, hashes, has letters).

    A text ends in one blank. Long texts are cut; an n-gram is counted to the part it
    begins in, and parts overlap so that each is seen once, as if there were no cut.
    """
    group: list[tuple[int, str, int]] = []
    size = 0
    reach = max(ORDERS) - 1

    def portion():
        points = np.frombuffer(
            "".join(part for _, part, _ in group).encode("utf-32-le", "surrogatepass"), np.uint32
        )
        letters = _letters()[points]
        points = np.where(letters, points, np.uint32(32)).astype(np.uint64)
        sizes = np.array([len(part) for _, part, _ in group])
        owner = np.repeat(np.array([k for k, _, _ in group]), sizes)
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        begins = np.repeat(np.array([last for _, _, last in group]), sizes)
        left = np.repeat(sizes, sizes) - place
        code = np.zeros(len(points), np.uint64)
        owners, hashes = [], []
        for order in ORDERS:
            shifted = points[order - 1 :]
            code = code[: len(shifted)] * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(1)
            mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            n = len(shifted)
            inside = (left[:n] >= order) & (place[:n] < begins[:n])
            hashes.append((mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64)[inside])
            owners.append(owner[:n][inside])
        return np.concatenate(owners), np.concatenate(hashes), np.unique(owner[letters])

    for k, text in enumerate(texts):
        text = text.lower() + " "
        for at in range(0, len(text), points_at_once):
            # N-grams begin in the first ``points_at_once`` places; the rest only ends them.
            part = text[at : at + points_at_once + reach]
            group.append((k, part, points_at_once))
            size += len(part)
            if size >= points_at_once:
                yield portion()
                group, size = [], 0
    if group:
        yield portion()


class Presence:
    """Which n-grams the texts of a batch have; one workspace for all batches."""

    def __init__(self, slots: np.ndarray, width: int):
        self.slots, self.width = slots, width
        self.rows = max(1, min(32, (1 << 23) // max(width, 1)))
        self.seen = np.zeros((self.rows, 1 << HASH_BITS), bool)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For at most ``rows`` texts: known n-grams (0 or 1), root of all, has letters."""
        table = np.zeros((len(texts), self.width + 1), np.float32)
        lettered = np.zeros(len(texts), bool)
        found = list(_grams(texts))
        for owner, hashes, with_letters in found:
            self.seen[owner, hashes] = True
            table[owner, self.slots[hashes]] = 1  # unknown n-grams fall into the last column
            lettered[with_letters] = True
        many = np.count_nonzero(self.seen[: len(texts)], axis=1)
        for owner, hashes, _ in found:
            self.seen[owner, hashes] = False
        return table[:, : self.width], np.sqrt(np.maximum(many, 1))[:, None], lettered

    def batches(self, texts: list[str]):
        for lo in range(0, len(texts), self.rows):
            yield lo, self.of(texts[lo : lo + self.rows])


def gram_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct hashed n-grams of each text."""
    out = []
    for text in texts:
        parts = [np.unique(hashes) for _, hashes, _ in _grams([text])]
        out.append(np.unique(np.concatenate(parts)))
    return out


#: Columns of the landmarks' table that are unpacked at once.
_COLUMNS = 1 << 14


def shared_grams(has: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """How many n-grams each row of ``has`` shares with every landmark (rows of bits)."""
    out = np.zeros((len(has), len(packed)))
    for lo in range(0, has.shape[1], _COLUMNS):
        bits = np.unpackbits(packed[:, lo // 8 : (lo + _COLUMNS) // 8], axis=1)
        part = has[:, lo : lo + _COLUMNS]
        out += part @ bits[:, : part.shape[1]].T.astype(np.float32)
    return out


def _picked(known: DataFrame, languages: list[str], rows: int, seed: int) -> DataFrame:
    """At most ``rows`` ids per language, by a hash of the id."""
    parts = [
        known.where(F.col("lang") == name).orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(rows)
        for name in languages
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def fit(
    docs: DataFrame, training: Column, *, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS, seed: int = 4,
) -> KernelModel:
    """Fit on at most ``landmarks + fit_rows`` documents per language where ``training`` holds.

    They are picked by a hash of the id among rows with id, text and language;
    ``ALL_LANDMARKS`` and ``ALL_FIT_ROWS`` bound them over all languages.
    Texts are reduced to n-gram sets and kernel rows on the executors; the driver
    gets those of the bounded sample. Without any such row the model knows no
    language.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.where(training).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where("id is not null and lang is not null and text is not null")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not languages:
        return KernelModel((), np.zeros(1 << HASH_BITS, np.int32), np.zeros((0, 0)), np.zeros(0))
    landmarks = max(1, min(landmarks, ALL_LANDMARKS // len(languages)))
    fit_rows = max(1, min(fit_rows, ALL_FIT_ROWS // len(languages)))
    ids = _picked(rows.select("id", "lang"), languages, landmarks + fit_rows, seed)
    shelf = Shelf(spark)
    sample = shelf.put(rows.join(F.broadcast(ids), ["id", "lang"]))  # bounded above
    marks = _picked(sample.select("id", "lang"), languages, landmarks, seed + 1)
    marked = shelf.put(sample.join(F.broadcast(marks.select("id")), "id", "left_semi"))

    def reduce_texts(batches):
        for batch in batches:
            sets = gram_sets(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.list_(pa.int64()))], names=["grams"]
            )

    sets = [
        np.array(r[0], np.int64)
        for r in marked.orderBy("id").select("text")
        .mapInArrow(reduce_texts, "grams array<bigint>").collect()
    ]
    grams = np.unique(np.concatenate(sets))
    width = len(grams)  # bounded by the landmarks, and by the hash
    slots = np.full(1 << HASH_BITS, width, np.int32)
    slots[grams] = np.arange(width)
    packed = np.zeros((len(sets), -(-width // 8)), np.uint8)
    for k, own in enumerate(sets):
        row = np.zeros(width, bool)
        row[slots[own]] = True
        packed[k] = np.packbits(row)
    norm = np.sqrt(np.array([len(own) for own in sets], np.float64))
    shared = np.concatenate(
        [shared_grams(np.unpackbits(row[None], axis=1, count=width).astype(np.float32), packed)
         for row in packed]
    )
    values, vectors = np.linalg.eigh(shared / norm[:, None] / norm)
    big = values > 1e-8 * values[-1]
    whiten = vectors[:, big] / np.sqrt(values[big]) / norm[:, None]
    project = spark.sparkContext.broadcast((slots, packed, whiten))  # bounded by the landmarks

    def kernel_rows(batches):
        known, marks, basis = project.value
        presence = Presence(known, width)
        for batch in batches:
            for lo, (has, root, _) in presence.batches(batch.column(1).to_pylist()):
                z = shared_grams(has, marks) @ basis / root
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(z)),
                     pa.array(list(z), pa.list_(pa.float64()))], names=["lang", "z"],
                )

    found = (
        sample.orderBy("id").select("lang", "text")
        .mapInArrow(kernel_rows, "lang string, z array<double>").collect()
    )
    shelf.clear()
    z = np.array([r[1] for r in found])
    z = np.concatenate((z, np.ones((len(z), 1))), axis=1)
    wanted = np.where(np.array([r[0] for r in found])[:, None] == np.array(languages), 1.0, -1.0)
    penalty = RIDGE * len(z) * np.eye(z.shape[1])
    penalty[-1, -1] = 0
    beta = np.linalg.solve(z.T @ z + penalty, z.T @ wanted)
    combined = whiten @ beta[:-1]
    weights = np.concatenate(
        [np.unpackbits(packed[:, lo : lo + _COLUMNS // 8], axis=1).T @ combined
         for lo in range(0, packed.shape[1], _COLUMNS // 8)]
    )[:width]
    return KernelModel(tuple(languages), slots, weights.astype(np.float32), beta[-1])


def identify(
    docs: DataFrame, model: KernelModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its whole text alone.

    Null texts and texts without letters are ``und`` with score 0, as is every
    text if the model knows no language. Equal scores go to the language first in
    order. Repeated rows keep a row each; other columns are not read.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the landmarks

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        presence = Presence(m.slots, len(m.weights))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, (has, root, lettered) in presence.batches(texts):
                best = np.full(len(has), len(m.languages))
                score = np.zeros(len(has))
                if m.languages:
                    margin = (has @ m.weights / root + m.offsets).astype(np.float64)
                    odds = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
                    odds /= odds.sum(axis=1, keepdims=True)
                    best = np.where(lettered, odds.argmax(axis=1), best)
                    score = np.where(lettered, odds.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(has)), pa.array(names[best], pa.string()),
                     pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
