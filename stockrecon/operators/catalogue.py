"""Products that have reimbursements but no stock row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from stockrecon.domain import PLACEHOLDER_TEXT, keys_of


def placeholder_value(field) -> Column:
    """Value of a stock column in a placeholder row."""
    if field.name in PLACEHOLDER_TEXT:
        value = F.lit(PLACEHOLDER_TEXT[field.name])
    else:
        value = F.lit(0 if isinstance(field.dataType, NumericType) else None)
    return value.cast(field.dataType)


def complete_catalogue(rec: DataFrame, rei: DataFrame) -> DataFrame:
    """Stock rows plus a placeholder for every product known only from ``rei``."""
    keys = keys_of(rec, "fnsku")
    # One grouping tells them apart: no join that sorts the keys of both sides again.
    known = rec.select(*keys, F.lit(1).alias("known"))
    asked = rei.select(*keys, F.lit(0).alias("known"))
    told = known.unionByName(asked).groupBy(*keys).agg(F.max("known").alias("known"))
    missing = told.where(F.col("known") == 0)
    rows = missing.select(
        *[
            F.col(f.name) if f.name in keys else placeholder_value(f).alias(f.name)
            for f in rec.schema
        ]
    )
    return rec.unionByName(rows)

