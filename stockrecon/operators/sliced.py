"""Joins on tables that are bucketed by product and slice.

A slice is a share of a product's rows, so that a product with very many rows lies in
many buckets; all other products have one slice. Whatever meets such a table comes once
per slice of its product; the table stays where it is. How many slices and buckets there
are is the comment of the column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.domain import keys_of

SLICE = "key_slice"
#: Cells that products are counted in, and rows up to which a cell is never crowded.
CELLS = 1 << 16
FEW_ROWS = 1_000
_LAST = "last_slice"


def is_sliced(df: DataFrame) -> bool:
    return SLICE in df.columns


def layout_text(slices: int, buckets: int) -> str:
    """Comment of the slice column of a bucketed table."""
    return f"{slices} slices, {buckets} buckets"


def layout(df: DataFrame) -> tuple[int, int]:
    """Slices of a product and buckets of the table."""
    slices, buckets = df.schema[SLICE].metadata["comment"].split(", ")
    return int(slices.split()[0]), int(buckets.split()[0])


def _crowded_cells(df: DataFrame, cell: Column, buckets: int) -> DataFrame:
    """Cells of products with more than half the rows of an average bucket.

    The counts, at most ``CELLS`` of them, meet in one row, so that rows are read for them once.
    """
    counted = df.groupBy(cell.alias("cell")).agg(F.count("*").alias("cell_rows"))
    most = F.greatest(F.lit(FEW_ROWS), F.sum("cell_rows") / F.lit(2 * buckets)).alias("most")
    cells = F.collect_list(F.struct("cell", "cell_rows")).alias("cells")
    crowded = F.filter("cells", lambda c: c["cell_rows"] > F.col("most"))
    return counted.agg(most, cells).select(F.explode(crowded["cell"]).alias("cell"))


def with_slice(df: DataFrame, slices: int, buckets: int) -> DataFrame:
    """Deal rows of crowded products to slices; all others are in slice 0.

    Products are counted by the cell their key falls in, at most ``CELLS`` rows, so that a
    landing takes one more pass over the keys and no shuffle of them. A product that shares
    the cell of a crowded one is dealt to slices too. Rows go by their content and input
    partition, so that copies spread; rows without a key, which meet nothing, always do.

    The slice is text: number columns of stock reports are counts.
    """
    keys = keys_of(df, "fnsku")
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS))
    content = F.xxhash64(*[f"`{c}`" for c in df.columns], F.spark_partition_id())
    crowded = _crowded_cells(df.select(*keys).dropna(), cell, buckets)
    marked = df.join(F.broadcast(crowded), cell == crowded["cell"], "left")
    spread = reduce(Column.__or__, [F.col(k).isNull() for k in keys], crowded["cell"].isNotNull())
    number = F.when(spread, F.pmod(content, F.lit(slices))).otherwise(0)
    return marked.select(*[df[f"`{c}`"] for c in df.columns], number.cast("string").alias(SLICE))


def _further(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and slice number of the rows of a sliced table that are not in slice 0."""
    rows = table.where(F.col(SLICE) != "0").dropna(subset=keys)
    return rows.select(*keys, F.col(SLICE).cast("int").alias(_LAST))


def _each_slice(df: DataFrame) -> DataFrame:
    numbers = F.sequence(F.lit(0), F.col(_LAST)).cast("array<string>")
    return df.withColumn(SLICE, F.explode(numbers)).drop(_LAST)


def per_slice(df: DataFrame, table: DataFrame) -> DataFrame:
    """Every row once per slice that its product has in the sliced ``table``, 0 included."""
    keys = keys_of(df, "fnsku")
    last = _further(table, keys).groupBy(*keys).agg(F.max(_LAST).alias(_LAST))
    return _each_slice(df.join(last, keys, "left").fillna(0, subset=[_LAST]))


def keep_matching_sliced(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the bucketed ``df`` whose keys occur in ``other``; only ``other`` moves."""
    wanted = other.select(*keys, F.lit(0).alias(_LAST), F.lit(True).alias("wanted"))
    further = _further(df, keys).withColumn("wanted", F.lit(False))
    found = wanted.union(further).groupBy(*keys).agg(
        F.max(_LAST).alias(_LAST), F.max("wanted").alias("wanted")
    )
    listed = _each_slice(found.where("wanted").drop("wanted"))
    return df.join(
        listed.repartition(layout(df)[1], *keys, SLICE), [*keys, SLICE], "left_semi"
    ).drop(SLICE)
