"""Lines that many documents share, by levelled sorted runs of line hashes.

Documents come in batches, largest ids first. A batch reduces to one row per line
key: in how many documents, and the largest id. It meets every run in a merge join;
keys that the runs together know from enough documents are taken out, the rest is
added as a sorted run of its own. Full levels are merged into one run of the next
level. All runs lie in the same buckets, each sorted by key, so merge joins and
compactions read them in place: only the batch itself is shuffled, once, after it was
combined.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

BLANKS = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
#: Runs of a level that are merged into one of the next.
FAN_IN = 2
_KEY = ["h1", "h2"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the stripped, A-Z lowered line; None if it is too short to count."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """Runs ``h1, h2, n, last`` on levels: documents that hold a key, and the largest id.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``, in which a batch arrives
    anyway; with another number Spark shuffles once more, and results are the same.
    """

    def __init__(
        self, shelf: Shelf, *, min_docs: int = MIN_DOCS, fan_in: int = FAN_IN,
        buckets: int | None = None,
    ):
        self.shelf = shelf
        self.min_docs = min_docs
        self.fan_in = fan_in
        self.buckets = buckets or int(shelf.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]

    def _merged(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Two runs as one. A join, as Spark 4.1 groups a union of bucketed scans wrongly."""
        theirs = right.select(*_KEY, F.col("n").alias("m"), F.col("last").alias("late"))
        rows = left.join(theirs, _KEY, "full").select(
            *_KEY,
            (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"),
            F.greatest("last", "late").alias("last"),
        )
        return self._run(rows)

    def _run(self, rows: DataFrame) -> DataFrame:
        return self.shelf.put_bucketed(rows, _KEY, self.buckets)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unsettled(self, own: DataFrame) -> DataFrame:
        """Rows of ``own`` whose key the runs do not yet know from enough documents."""
        known, columns = F.lit(0), own.columns
        for i, run in enumerate(self.runs()):
            own = own.join(run.select(*_KEY, F.col("n").alias(f"n{i}")), _KEY, "left")
            known += F.coalesce(f"n{i}", F.lit(0))
        return own.where(known < self.min_docs).select(*columns)

    def add(self, batch: DataFrame) -> None:
        """Take in ``doc_id, h1, h2``, one row per document and key, ids below all earlier ones."""
        own = batch.groupBy(*_KEY).agg(
            F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")
        )
        self.levels[0].append(self._run(self.unsettled(own)))
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(reduce(self._merged, self.levels[level]))
            self.levels[level] = []
            level += 1

    def settled(self) -> DataFrame:
        """Keys known from enough documents, with the id that keeps them; merges all runs."""
        whole = reduce(self._merged, self.runs())
        self.levels = [[] for _ in self.levels[1:]] + [[whole]]
        return whole.where(F.col("n") >= self.min_docs)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, h1, h2`` for every key of a document, each once."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            counts, found = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                keys = {line_key(line, min_chars) for line in (text or b"").split(b"\n")}
                keys.discard(None)
                counts.append(len(keys))
                found.extend(keys)
            owner = np.repeat(np.arange(len(counts)), counts)
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(halves[:, 0]),
                 pa.array(halves[:, 1])],
                names=["doc_id", *_KEY],
            )

    return docs.mapInArrow(run, "doc_id long, h1 long, h2 long")


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Number of the batch of a ``doc_id``, 0 for the largest ids."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.approxQuantile("doc_id", shares, 0.01) if shares else []
    below = [F.when(F.col("doc_id") >= cut, 0).otherwise(1) for cut in cuts]
    return reduce(Column.__add__, below, F.lit(0))


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_text``.

    A line key of at least ``min_chars`` code points in at least ``min_docs``
    documents loses all its lines except in the document with the largest id.
    Null and empty texts are one empty line. Repeated rows are documents of their
    own for the count and keep or lose lines alike; rows without an id are counted
    but lose nothing. Other columns are not read; an empty table gives no rows.
    """
    shelf = Shelf(docs.sparkSession)
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    keys = line_keys(source, min_chars).withColumn("batch", _batch_of(source, batches))
    keys = shelf.put(keys, partition_by=("batch",))
    runs = LineRuns(shelf, min_docs=min_docs)
    for batch in range(batches):
        runs.add(keys.where(F.col("batch") == batch).select("doc_id", *_KEY))
    frequent = shelf.put(runs.settled().select(*_KEY, "last"))
    drops = (
        # Written tables on both sides: Spark splits the documents of a frequent line.
        keys.select("doc_id", *_KEY).join(frequent, _KEY)
        .where("doc_id is not null and not doc_id <=> last")
        .groupBy("doc_id").agg(F.collect_set(F.struct(*_KEY)).alias("dropped"))
    )
    drops = shelf.put(drops)

    def cut(batches):
        for batch in batches:
            lists = batch.column(2)
            inner = lists.flatten()
            pairs = np.stack(
                [np.asarray(inner.field(i).to_numpy(zero_copy_only=False), np.int64)
                 for i in (0, 1)], axis=1,
            )
            keyed = pairs.tobytes()
            sizes = lists.value_lengths().fill_null(0).to_pylist()
            lines_of, lost_of, kept_of, at = [], [], [], 0
            for text, size in zip(batch.column(1).cast(pa.binary()).to_pylist(), sizes):
                gone = {keyed[i : i + 16] for i in range(16 * at, 16 * (at + size), 16)}
                at += size
                lines = (text or b"").split(b"\n")
                kept = [x for x in lines if not gone or line_key(x, min_chars) not in gone]
                lines_of.append(len(lines))
                lost_of.append(len(lines) - len(kept))
                kept_of.append(b"\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lines_of, pa.int64()), pa.array(lost_of, pa.int64()),
                 pa.array(kept_of, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_text"],
            )

    return source.join(drops, "doc_id", "left").mapInArrow(
        cut, "doc_id long, n_lines long, n_dropped long, kept_text string"
    )
