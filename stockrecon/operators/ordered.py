"""Ordered scans over range blocks: values of neighbour rows without a window per key.

Rows are dealt by range of their key and order columns and stored, so that every row
has a block for good. A block holds a bounded share of the rows however they spread
over keys. What a scan needs from outside its block, the rows next to it and values
carried along, comes from one small row per key and block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.operators.skew import broadcast_if_small
from stockrecon.sources.scratch import store

BLOCK = "range_block"


def range_blocks(
    df: DataFrame, by: list[str], order: list[str],
    keep: Callable[[DataFrame], DataFrame] = store, blocks: int | None = None,
) -> DataFrame:
    """``df`` with the number of its range block, stored by ``keep``.

    Within a key a greater block holds later rows, nulls last. Rows that are equal in
    all these columns share a block, so end ``order`` in columns that tell rows apart.
    """
    ranges = [F.col(c).asc() for c in by] + [F.col(c).asc_nulls_last() for c in order]
    dealt = df.repartitionByRange(blocks, *ranges) if blocks else df.repartitionByRange(*ranges)
    return keep(dealt.withColumn(BLOCK, F.spark_partition_id()))


def in_block(by: list[str], order: list[str]):
    """Window over the rows of one key in one block, in order."""
    return Window.partitionBy(*by, BLOCK).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def _over_blocks(by: list[str]):
    return Window.partitionBy(*by).orderBy(BLOCK)


def with_edges(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """Add ``edge_before`` and ``edge_after``: the values of ``column`` next to the block.

    ``column`` is what rows are ordered by; nulls are no neighbours. One row per key
    and block is ordered for it.
    """
    edges = rows.groupBy(*by, BLOCK).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    blocks = _over_blocks(by)
    until = blocks.rowsBetween(Window.unboundedPreceding, -1)
    beyond = blocks.rowsBetween(1, Window.unboundedFollowing)
    edges = edges.select(
        *by, BLOCK,
        F.last("hi", ignorenulls=True).over(until).alias("edge_before"),
        F.first("lo", ignorenulls=True).over(beyond).alias("edge_after"),
    )
    return _on_block(rows, edges, by)


def with_carried(rows: DataFrame, by: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` at or before each row of its key."""
    tails = (
        rows.where(F.col(value).isNotNull()).groupBy(*by, BLOCK)
        .agg(F.max_by(value, F.struct(*_last_key(order))).alias("tail"))
    )
    value_type = rows.schema[value].dataType
    blocks = rows.select(*by, BLOCK, F.lit(None).cast(value_type).alias("tail"))
    either = blocks.unionByName(tails).groupBy(*by, BLOCK).agg(F.max("tail").alias("tail"))
    until = _over_blocks(by).rowsBetween(Window.unboundedPreceding, -1)
    carried = either.select(
        *by, BLOCK, F.last("tail", ignorenulls=True).over(until).alias("carried")
    )
    own = in_block(by, order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _on_block(rows, carried, by)
        .withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(own), "carried"))
        .drop("carried")
    )


def _last_key(order: list[str]) -> list[Column]:
    """Columns whose greatest struct is the last row in order, nulls last."""
    return [x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]


def with_number(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the number of each row within its key, from 1, in order."""
    counts = rows.groupBy(*by, BLOCK).agg(F.count(F.lit(1)).alias("many"))
    until = _over_blocks(by).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, BLOCK, F.coalesce(F.sum("many").over(until), F.lit(0)).alias("offset")
    )
    number = F.col("offset") + F.row_number().over(in_block(by, order))
    return _on_block(rows, offsets, by).withColumn(name, number).drop("offset")


def _on_block(rows: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the facts of their key and block; null keys match themselves.

    The facts are stored and, where counting shows them to be few, broadcast, so that rows
    are shuffled for their window alone.
    """
    named = broadcast_if_small(store(facts)).withColumnsRenamed({c: f"_{c}" for c in [*by, BLOCK]})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, BLOCK]]
    return rows.join(named, same, "left").drop(*[f"_{c}" for c in [*by, BLOCK]])
