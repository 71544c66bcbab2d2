"""Spelling variants by a dictionary of trie-node pairs.

All words lie in one trie by their prefixes and in one by their suffixes, and the
nodes of both are numbered. A word without the code point at some place is then a
pair of integers (prefix node, suffix node), and so is a word with room for one more
code point at some place. Two words that differ by one replaced code point share a
pair of the first kind; a word and one that is a code point longer share a pair of
both kinds. Words that share a pair of the first kind differ at one place only, so
that many letters as there are bound them, and the second kind names one word.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

MIN_CHARS = 6
MIN_COUNT = 5
#: How much more frequent a word's form must be.
RATIO = 5
#: One in so many of the runs of a document loses a code point.
MISSPELT = 199
_RUN = re.compile("[a-zÀ-ÿ]+")
#: Words that a task counts before it hands over.
_HELD = 1 << 19


def spelt(run: str, seed: int, one_in: int = MISSPELT) -> str:
    """The run as it counts, ``seed`` being the checksum of all that stands before it."""
    h = zlib.crc32(run.encode(), seed)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(min_chars: int):
    """Map side: ``word, n``, every word once a task, or once for each full table."""

    def table(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
            names=["word", "n"],
        )

    def run(batches):
        found: dict[str, int] = {}
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(ids, texts):
                seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                known: dict[str, str] = {}
                for one in _RUN.findall((text or b"").lower().decode()):
                    if len(one) < min_chars:
                        continue
                    word = known.get(one)
                    if word is None:
                        word = known[one] = spelt(one, seed)
                    if len(word) >= min_chars:
                        found[word] = found.get(word, 0) + 1
                if len(found) >= _HELD:
                    yield table(found)
                    found = {}
        yield table(found)

    return run


def count_words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word, n``: words of at least ``min_chars`` code points and ``min_count`` occurrences."""
    ship_package(docs.sparkSession)
    return (
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
        .mapInArrow(_counts(min_chars), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    )


_PLACES = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("skip", pa.bool_()), ("lead", pa.bool_()),
     ("prefix", pa.binary()), ("suffix", pa.binary())]
)


def _digests(word: str) -> list[bytes]:
    """128-bit digests of all prefixes, the empty one first; each from the one before."""
    out = [b""]
    for point in word:
        out.append(xxhash.xxh3_128_digest(out[-1] + point.encode()))
    return out


def _places(batches):
    """Every place of every word: the trie nodes before and after it.

    ``skip`` leaves out the code point at the place, else the place is a gap. Of equal
    code points in a row only the first is a ``lead``: leaving out any gives one word.
    """
    for batch in batches:
        rows: list[list] = [[], [], [], [], [], []]
        words, ids, counts = (batch.column(i).to_pylist() for i in range(3))
        for word, one, n in zip(words, ids, counts):
            before, after = _digests(word), _digests(word[::-1])[::-1]
            size = len(word)
            lead = [i == 0 or word[i] != word[i - 1] for i in range(size)]
            rows[0] += [one] * (2 * size + 1)
            rows[1] += [n] * (2 * size + 1)
            rows[2] += [True] * size + [False] * (size + 1)
            rows[3] += lead + [True] * (size + 1)
            rows[4] += before[:-1] + before
            rows[5] += after[1:] + after
            if len(rows[0]) >= 1 << 17:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, _PLACES.types)], schema=_PLACES
                )
                rows = [[], [], [], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, _PLACES.types)], schema=_PLACES
        )


def _numbered(places: DataFrame, node: str, shelf: Shelf) -> DataFrame:
    """Nodes of one trie and their numbers, written once so that they stay."""
    return shelf.put(
        places.select(node).distinct().withColumn(f"{node}_node", F.monotonically_increasing_id())
    )


def node_pairs(words: DataFrame, shelf: Shelf) -> DataFrame:
    """``prefix_node, suffix_node, id, n, skip, lead`` for every place of ``word, id, n``."""
    places = shelf.put(
        words.select("word", "id", "n").mapInArrow(
            _places, "id long, n long, skip boolean, lead boolean, prefix binary, suffix binary"
        )
    )
    # Written tables: Spark splits the places of the roots and other crowded nodes.
    for node in ("prefix", "suffix"):
        places = places.join(_numbered(places, node, shelf), node).drop(node)
    return places


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best``: near words of each word, the best as ``(n, -id)``.

    A pair's members are at most one for each letter and one more. No links are
    emitted: every member sums up what it sees of its own group.
    """
    members = F.collect_list(
        F.struct("skip", "lead", "n", (-F.col("id")).alias("order"))
    )
    groups = (
        pairs.groupBy("prefix_node", "suffix_node").agg(members.alias("all"))
        .where(F.size("all") > 1)
    )

    def seen(x):
        others = F.filter(
            "all",
            lambda y: (y["order"] != x["order"])
            & F.when(x["skip"], y["skip"] | x["lead"]).otherwise(y["skip"] & y["lead"]),
        )
        best = F.array_max(
            F.transform(others, lambda y: F.struct(y["n"].alias("n"), y["order"].alias("order")))
        )
        return F.struct(
            (-x["order"]).alias("id"), F.size(others).cast("long").alias("near"), best.alias("best")
        )

    return (
        groups.select(F.explode(F.transform("all", seen)).alias("w"))
        .groupBy("w.id").agg(F.sum("w.near").alias("n_near"), F.max("w.best").alias("best"))
    )


def roots(forms: DataFrame, shelf: Shelf) -> DataFrame:
    """``id, root`` for every ``id, form``: where the forms lead to, by pointer jumping.

    A form is at least ``RATIO`` times as frequent, so chains are short and never closed.
    """
    now = shelf.put(forms.select("id", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = shelf.put(now.join(ahead, "root", "left"))
        now = moved.select("id", F.coalesce("further", "root").alias("root"))
        if not moved.where("further is not null").limit(1).count():
            return now


def group_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lowered,
    one in ``MISSPELT`` of a document's distinct runs without one code point. Those of
    at least ``min_chars`` code points and ``min_count`` occurrences count. Words are
    near if they differ by one inserted, deleted or replaced code point. A word's form
    is its most frequent near word (the first in code-point order of equal ones) if that is
    ``ratio`` times as frequent, else null; ``root`` is where forms lead to. Null texts
    have no words, a null id is an empty text in the checksum, repeated rows count
    each; an empty table gives no rows. Nodes are told apart by 128-bit digests.
    """
    shelf = Shelf(docs.sparkSession)
    counted = count_words(
        docs, id_col=id_col, text_col=text_col, min_chars=min_chars, min_count=min_count
    )
    # Ids in code-point order.
    words = shelf.put(counted.orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    near = near_words(node_pairs(words, shelf))
    judged = shelf.put(
        words.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.order")).alias("form_id"),
        )
    )
    led = roots(judged.where("form_id is not null").select("id", F.col("form_id").alias("form")), shelf)
    by_id = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"),
                         F.col("n").alias("form_n"))
    root_words = led.join(
        words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root"
    ).select("id", "root_word")
    return (
        judged.join(by_id, "form_id", "left").join(root_words, "id", "left")
        .select(
            "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
        )
    )
