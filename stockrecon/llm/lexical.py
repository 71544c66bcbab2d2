"""Ranked lexical search by bag deduplication.

Documents are restricted to the terms of the items. What a document scores depends
on its term counts among these and on its length figure ``m`` alone, so documents
that agree in both are one class: a hash finds it, the counts verify it. A class is
scored once, and of its members only the first by id can be in a result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

#: Items, and about as many of their distinct terms, that are asked in one pass.
BLOCK_ITEMS = 256
BLOCK_TERMS = 1 << 16
#: Classes scored together.
BATCH = 256
#: Sums below this are exact in double precision.
_EXACT = 2**53

# ASCII letters and digits and all bytes beyond ASCII are parts of terms.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order, A-Z lowered."""
    return text.translate(_PLAIN).split()


def _bags(vocabulary):
    """``doc_id, n, bag``: terms in all, and (term number, count) pairs by number."""

    def run(batches):
        number = vocabulary.value
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                terms = terms_of(text or b"")
                counts = Counter(number[t] for t in terms if t in number)
                sizes.append(len(terms))
                bags.append(np.array(sorted(counts.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"],
            )

    return run


def _holders(batches):
    """How many bags of the task hold each term: ``term, df``."""
    total = Counter()
    for batch in batches:
        joined = b"".join(batch.column(0).to_pylist())
        numbers, counts = np.unique(np.frombuffer(joined, "<u4")[::2], return_counts=True)
        total.update(dict(zip(numbers.tolist(), counts.tolist())))
    yield pa.RecordBatch.from_pydict(
        {"term": pa.array(list(total), pa.int64()), "df": pa.array(list(total.values()), pa.int64())}
    )


def _scores(items, k: int):
    """The ``k`` best classes of the task for every item: ``item, class, score, hash``."""

    def best_of(held: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        return rows[np.arange(len(rows)) - first < k]

    def run(batches):
        wanted, weight = items.value  # terms by items, 0 or 1; weight of every term
        held = [np.empty((0, 4), np.int64)]
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                bags = [np.frombuffer(b, "<u4").reshape(-1, 2) for b in part.column(1).to_pylist()]
                pairs = np.concatenate(bags).astype(np.int64)
                row = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
                used, column = np.unique(pairs[:, 0], return_inverse=True)
                m = part.column(2).to_numpy()[row]
                tf = pairs[:, 1]
                gain = weight[used][column] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                exact = len(used) * int(gain.max(initial=0)) < _EXACT
                table = np.zeros((len(bags), len(used)), np.float64 if exact else np.int64)
                table[row, column] = gain
                score = (table @ wanted[used].astype(table.dtype)).astype(np.int64)
                least, digest = (part.column(i).to_numpy() for i in (0, 3))
                # Only classes that may be among the best of their batch go on.
                keep = score > 0
                if len(score) > k:
                    keep &= score >= np.partition(score, len(score) - k, axis=0)[-k]
                at, item = np.nonzero(keep)
                held.append(np.stack((item, least[at], score[at, item], digest[at]), axis=1))
            if len(held) > 64:
                held = [best_of(held)]
        rows = best_of(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[:, i]) for i in range(4)], names=["item", "class", "score", "hash"]
        )

    return run


def _blocks(asked: list, most_items: int, most_terms: int):
    """Cut (item, terms) into blocks: a block ends when it has enough of either."""
    block, known = [], set()
    for item, terms in asked:
        block.append((item, terms))
        known.update(terms)
        if len(block) >= most_items or len(known) >= most_terms:
            yield block, sorted(known)
            block, known = [], set()
    if block:
        yield block, sorted(known)


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [
                sorted(set(terms_of(t or b"")))
                for t in batch.column(1).cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"]
            )

    return (
        items.where(F.col(item_col).isNotNull())
        .select(F.col(item_col).cast("long"), F.col(text_col).cast("string"))
        .mapInArrow(run, "item long, terms array<binary>")
    )


def _first_rows(df: DataFrame, number: str, by: list[str], order: list[Column], k: int):
    """The first ``k`` rows of each group; Spark limits groups before the shuffle too."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= k)


def rank_documents(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", k: int = 10,
    block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item.

    A term weighs ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, a document has
    ``m = 10 + (90 n N) div L`` (``N`` documents with terms, ``L`` terms in all, ``n`` its
    own), and its score sums ``weight * ((10^9 tf) div (1000 tf + 8 m))`` over the
    item's terms, once each. Scores of 0 are left out, equal scores go by ascending
    id. Null texts have no terms. Documents without an id count in ``N``, ``L`` and
    ``df`` but are in no result; rows of one id are documents of their own. Rows of
    one item are asked as one, items without an id are not asked. An empty table on
    either side gives no rows.

    The items are the query set: they are asked in blocks of ``block_items``, or as
    many as have ``block_terms`` distinct terms, and the driver holds one block.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shelf = Shelf(spark)
    asked: dict[int, set] = {}
    blocks = []
    for item, terms in _item_terms(items, item_col, item_text_col).toLocalIterator():
        asked.setdefault(item, set()).update(map(bytes, terms))
    for block, words in _blocks(sorted(asked.items()), block_items, block_terms):
        blocks.append(_rank_block(docs, shelf, block, words, id_col, text_col, k))
    if not blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = blocks[0]
    for block in blocks[1:]:
        found = found.unionByName(block)
    return found


def _rank_block(docs, shelf, block, words, id_col, text_col, k) -> DataFrame:
    context = docs.sparkSession.sparkContext
    number = {t: i for i, t in enumerate(words)}
    vocabulary = context.broadcast(number)  # bounded by the block
    bags = shelf.put(
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
        .mapInArrow(_bags(vocabulary), "doc_id long, n long, bag binary")
        .where("n > 0")
    )
    total = bags.agg(F.count(F.lit(1)), F.sum("n")).collect()[0]
    n_docs, n_terms = total[0], total[1] or 0
    held = (
        bags.select("bag").mapInArrow(_holders, "term long, df long")
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    )  # fmt: skip  # a row per term of the block
    df = np.zeros(len(words), np.int64)
    for term, count in held:
        df[term] = count
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    wanted = np.zeros((len(words), len(block)), np.uint8)
    for i, (_, terms) in enumerate(block):
        wanted[[number[t] for t in terms], i] = 1
    table = context.broadcast((wanted, weight))  # bounded by the block

    m = 10 + F.expr(f"(90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    classed = (
        bags.where("doc_id is not null and length(bag) > 0")
        .select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    )
    # The hash is the key; the bags beside it verify it.
    members = shelf.put(
        _first_rows(classed, "nth", ["hash", "bag", "m"], [F.col("doc_id")], k)
    )
    first = members.where("nth = 1").select(F.col("doc_id").alias("class"), "bag", "m", "hash")
    best = first.mapInArrow(_scores(table, k), "item long, class long, score long, hash long")
    best = _first_rows(best, "place", ["item"], [F.desc("score"), F.col("class")], k)
    expanded = (
        best.select("item", "class", "score", "hash").join(first, ["class", "hash"])
        .join(members, ["hash", "bag", "m"])
    )
    ranked = _first_rows(expanded, "rank", ["item"], [F.desc("score"), F.col("doc_id")], k)
    ids = F.array(*[F.lit(item).cast("long") for item, _ in block])
    return ranked.select(
        F.get(ids, F.col("item").cast("int")).alias("item_id"), "rank", "doc_id", "score"
    )
