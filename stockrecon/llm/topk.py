"""Exact top-k by inner product, by aggregation without random access.

Every dimension is a list of the candidates sorted by their component. A query
reads its lists in sequence from the end that adds most, a layer deeper each time,
and adds what the new layer holds to what it has seen. Seen entries and the edges
of the unread rest give every candidate a lower and an upper bound of its score;
candidates whose upper bound is under the bar are out. The bar is the k-th lower
bound in the block, or the k-th best of all earlier blocks where that is higher.
Reading stops when few are left, and only those get their final score. The sums of
a batch of queries are matrix products: a layer is the same for all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

#: Candidates and queries that meet in one task.
CANDIDATE_BLOCK = 8_192
QUERY_BLOCK = 16_384
#: Blocks that are read without a bar, and how many times the blocks read so far come next.
FIRST_BLOCKS = 16
GROWTH = 16
#: Share of each list that has been read after each step.
DEPTHS = (1 / 16, 1 / 4, 1 / 2, 1)
#: Queries whose bounds are computed together.
BATCH = 128
#: Scores that cannot pass this are computed as 64-bit integers.
_LONG = 2.0**63


class SortedLists:
    """The sorted lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.place = np.empty_like(order, np.int32)
        np.put_along_axis(self.place, order, np.arange(len(ids))[:, None], axis=0)
        self.sorted = np.take_along_axis(vectors, order, axis=0).astype(np.float64)
        self.largest = float(np.abs(self.sorted).max(initial=0))
        self.layers: dict[int, tuple] = {}

    def _layer(self, step: int) -> tuple:
        """What a step reads of both ends of all lists, what it leaves unread, the two edges."""
        if step not in self.layers:
            n = len(self.ids)
            before, depth = (math.ceil(s * n) for s in ((0, *DEPTHS)[step], DEPTHS[step]))
            from_top = n - 1 - self.place
            new = np.concatenate(
                [self.vectors * ((p >= before) & (p < depth)) for p in (from_top, self.place)],
                axis=1,
            )
            unread = np.concatenate((from_top >= depth, self.place >= depth), axis=1)
            self.layers[step] = (
                np.ascontiguousarray(new.T, np.float64),
                np.ascontiguousarray(unread.T, np.float64),
                self.sorted[n - depth], self.sorted[depth - 1],
            )
        return self.layers[step]

    def _reach(self, queries: np.ndarray) -> float:
        """No sum of products of a query and a candidate can be larger."""
        largest = float(np.abs(queries.astype(np.float64)).max(initial=0))
        return self.largest * largest * max(1, queries.shape[1])

    def _alive(
        self, own: np.ndarray, queries: np.ndarray, k: int, bars: np.ndarray | None = None
    ) -> np.ndarray:
        """Queries by candidates: who can still be among the best ``k`` and reach the bar."""
        alive = self.ids[None, :] != own[:, None]
        bars = np.full(len(own), -np.inf) if bars is None else bars
        # More than rounding can shift two sums of up to four times as many terms as a vector has.
        slack = self._reach(queries) * (queries.shape[1] + 2) * 2.0**-49
        open_ = np.flatnonzero((alive.sum(axis=1) > 4 * k) | (bars > -np.inf))
        held = np.arange(len(self.ids))
        seen = np.zeros((len(open_), len(held)))
        for step, share in enumerate(DEPTHS):
            if not len(open_):
                break
            new, unread, top_edge, bottom_edge = self._layer(step)
            if len(held) < len(self.ids):
                new, unread = new[:, held], unread[:, held]
            asked = queries[open_].astype(np.float64)
            up, down = np.maximum(asked, 0.0), np.minimum(asked, 0.0)
            seen += np.concatenate((up, down), axis=1) @ new
            most = least = seen
            if share < 1:
                # An unread entry adds at most its list's edge, at least its list's far end.
                most = np.concatenate((up * top_edge, down * bottom_edge), axis=1) @ unread
                least = np.concatenate(
                    (up * self.sorted[0], down * self.sorted[-1]), axis=1
                ) @ unread
                most += seen
                least += seen
            part = alive[open_][:, held] if len(held) < len(self.ids) else alive[open_]
            bar = bars[open_]
            if len(held) >= k:
                least = np.where(part, least, -np.inf)
                bar = np.maximum(bar, np.partition(least, len(held) - k, axis=1)[:, -k])
            part &= most >= (bar - slack)[:, None]
            if len(held) < len(self.ids):
                alive[np.ix_(open_, held)] = part
            else:
                alive[open_] = part
            further = np.flatnonzero(part.sum(axis=1) > 4 * k)
            kept = np.flatnonzero(part[further].any(axis=0))
            if len(further) < len(open_):
                open_, seen = open_[further], seen[further]
            if len(kept) <= len(held) // 2:
                held, seen = held[kept], seen[:, kept]
        return alive

    def _scores(self, left: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self._reach(query[None, :]) < _LONG:
            return self.vectors[left] @ query
        scores = [sum(map(int.__mul__, v, query.tolist())) for v in self.vectors[left].tolist()]
        if any(abs(s) >= _LONG for s in scores):
            raise OverflowError("a score does not fit a long")
        return np.array(scores, np.int64)

    def top(
        self, own: np.ndarray, queries: np.ndarray, k: int,
        bars: np.ndarray | None = None, bar_ids: np.ndarray | None = None,
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and scores of the best ``k``, equal scores by smaller id.

        With ``bars``, the score that a query's k-th best candidate has so far, and
        ``bar_ids``, its id: only candidates that come before it.
        """
        found = []
        for at in range(0, len(own), BATCH):
            part = slice(at, at + BATCH)
            floors = None if bars is None else bars[part].astype(np.float64)
            if floors is not None:
                floors[floors <= -_LONG] = -np.inf
            alive = self._alive(own[part], queries[part], k, floors)
            for i, here in enumerate(alive, at):
                left = np.flatnonzero(here)
                score = self._scores(left, queries[i])
                if bars is not None:
                    before = (score > bars[i]) | (
                        (score == bars[i]) & (self.ids[left] < bar_ids[i])
                    )
                    left, score = left[before], score[before]
                # The complement turns the order round and, unlike the negative, fits any long.
                best = np.lexsort((self.ids[left], ~score))[:k]
                found.append((self.ids[left[best]], score[best]))
        return found


def _scaled(vector: str, factor: int):
    """Components as ``floor(factor * x)``; null where one is null or not finite."""
    x = F.col(vector)
    bad = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    )
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * factor).cast("long"))
    return F.when(x.isNotNull() & ~bad, whole)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def rounds(blocks: int, first: int, growth: int) -> list[tuple[int, int]]:
    """First and last block of each round; a round has ``growth`` times the blocks before it."""
    ends = [min(blocks, first)]
    while ends[-1] < blocks:
        ends.append(min(blocks, ends[-1] * (1 + growth)))
    return [(start, end - 1) for start, end in zip([0, *ends], ends)]


def top_k(
    vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id",
    vector_col: str = "embedding", k: int = 10, factor: int = 1024,
    candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
    first_blocks: int = FIRST_BLOCKS, growth: int = GROWTH,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query.

    Both tables have ``id_col`` and ``vector_col``; a candidate with the query's
    id is left out. The score is the integer inner product of
    ``floor(factor * x)``, ties go to the smaller id, fewer candidates give fewer
    rows. Vectors that are null or hold a null or non-finite component take no
    part, shorter vectors are filled up with zeros, a repeated row is a candidate
    of its own, and of a repeated query id the greatest vector is asked. Bounds
    allow for what rounding can shift, so they hold for scores of any size; a score
    that does not fit a long is an error.

    Blocks of candidates are dealt by hash and read in rounds. After the
    ``first_blocks``, each round reads ``growth`` times the blocks before it, and a
    query's k-th best of those is its bar: on average a round hands on no more than
    ``k * growth`` rows for a query, and the first one ``k * first_blocks``, however
    many blocks there are. Nothing is left out; a bar only rules out what cannot be
    among the best.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    shelf = Shelf(spark)

    def usable(df: DataFrame) -> DataFrame:
        return df.select(
            F.col(id_col).cast("long").alias("id"), _scaled(vector_col, factor).alias("v")
        ).where("id is not null and v is not null")

    candidates = shelf.put(usable(vectors))
    asked = shelf.put(usable(queries).groupBy("id").agg(F.max("v").alias("v")))
    n_candidates, n_asked = candidates.count(), asked.count()
    rows, columns = (
        max(1, -(-n_candidates // candidate_block)), max(1, -(-n_asked // query_block)),
    )
    # Hash blocks: every candidate meets every block of queries, once.
    left = candidates.select(
        "id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(rows)).alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))).alias("b"),
    )

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found: list[tuple] = [(), (), ()]
        if mine.num_rows and theirs.num_rows:
            width = max(
                max(t.column("v").combine_chunks().value_lengths().to_pylist())
                for t in (mine, theirs)
            )
            lists = SortedLists(mine.column("id").to_numpy(), _matrix(mine.column("v"), width))
            asked_ids, *bars = (theirs.column(c).to_numpy() for c in ("id", "bar", "bar_id"))
            tops = lists.top(asked_ids, _matrix(theirs.column("v"), width), k, *bars)
            found = [
                np.repeat(asked_ids, [len(ids) for ids, _ in tops]),
                np.concatenate([ids for ids, _ in tops]),
                np.concatenate([scores for _, scores in tops]),
            ]
        return pa.table(
            [pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"]
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    so_far = None
    for start, end in rounds(rows, first_blocks, growth):
        barred = asked.withColumns(
            {"bar": F.lit(-(2**63)).cast("long"), "bar_id": F.lit(-(2**63)).cast("long")}
        )
        if so_far is not None:
            so_far = shelf.put(so_far)
            kth = so_far.where(F.col("rank") == k).select(
                F.col("query_id").alias("id"), F.col("score").alias("bar"),
                F.col("vec_id").alias("bar_id"),
            )
            barred = asked.join(kth, "id", "left").fillna(-(2**63), ["bar", "bar_id"])
        right = barred.select(
            "*", F.pmod(F.xxhash64("id", "v"), F.lit(columns)).alias("b"),
            F.explode(
                F.sequence(F.lit(start).cast("long"), F.lit(end).cast("long"))
            ).alias("a"),
        )
        partial = (
            left.where(F.col("a").between(start, end)).groupBy("a", "b")
            .cogroup(right.groupBy("a", "b"))
            .applyInArrow(meet, "query_id long, vec_id long, score long")
        )
        if so_far is not None:
            partial = partial.unionByName(so_far.drop("rank"))
        so_far = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return so_far.select("query_id", "rank", "vec_id", "score")
