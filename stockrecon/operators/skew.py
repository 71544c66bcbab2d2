"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COPIES = 64
BROADCAST_ROWS = 100_000


def join_by(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``df.join(other, keys, how)`` whose sorts look at the client last.

    A sort compares rows by the first bytes of its first key and reads both rows wherever
    these are equal. A client has very many rows; a product or bucket has few.
    """
    finest = [k for k in keys if k != "client"] + [k for k in keys if k == "client"]
    joined = df.join(other, finest, how)
    rest = [c for c in joined.columns if c not in keys]
    return joined.select(*[f"`{c}`" for c in [*keys, *rest]])


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast after counting that it has at most ``limit`` rows.

    For short key lists whose size the planner cannot guess. Runs a job; beyond
    the limit the frame is returned as it is and joins shuffle.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _thinned(df: DataFrame, keys: list[str]) -> DataFrame:
    copy = F.pmod(F.spark_partition_id(), F.lit(KEY_COPIES)).alias("copy")
    thin = df.select(*keys, copy).groupBy(*keys, "copy").agg(F.count("*").alias("n"))
    return thin.select(*keys)


def keep_matching(
    df: DataFrame, other: DataFrame, keys: list[str], in_order: bool = False
) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``other``.

    Repeats in ``other`` are first thinned to a fixed number of copies per key.
    Grouping by a copy number too means the join still shuffles both sides
    itself, which is what lets adaptive execution split a hot key of ``df``. ``in_order``
    shuffles and sorts by the keys as they are given.
    """
    if in_order:
        return df.join(_thinned(other, keys), keys, "left_semi")
    return join_by(df, _thinned(other, keys), keys, "left_semi")


def keep_missing(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``other``, thinned in the same way.

    The join is always by merge: the planner takes the size of ``other`` from its files, which
    says nothing about rows that multiply after the scan, and would broadcast all its keys.
    """
    return join_by(df, _thinned(other, keys).hint("merge"), keys, "left_anti")
