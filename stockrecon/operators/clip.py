"""Date range filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.functions.dates import cutoff


def clip_since(
    df: DataFrame, date_column: str, as_of: dt.date | str, opening: dt.date | str | None = None
) -> DataFrame:
    """Rows on or after the cut-off; rows without a date go."""
    dtype = df.schema[date_column].dataType
    return df.where(F.col(date_column) >= cutoff(as_of, opening, dtype))


def clip_adjustments(adj: DataFrame, as_of, opening=None) -> DataFrame:
    return clip_since(adj, "adjusted_date", as_of, opening)


def clip_reimbursements(rei: DataFrame, as_of, opening=None) -> DataFrame:
    return clip_since(rei, "approval_date", as_of, opening)
