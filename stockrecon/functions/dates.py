"""History window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from stockrecon.domain import HISTORY_MONTHS


def cutoff(
    as_of: dt.date | str,
    opening: dt.date | str | None = None,
    dtype: DataType = StringType(),
) -> Column:
    """First day kept: ``as_of`` minus 18 months, or ``opening`` if that is later.

    The result is a constant of type ``dtype``, so a comparison with a stored
    column folds to a literal and reaches the file scan. Text columns get ISO
    text and are compared as text.
    """
    start = F.add_months(F.lit(str(as_of)).cast("date"), -HISTORY_MONTHS).cast(dtype)
    if opening is None:
        return start
    return F.greatest(F.lit(str(opening)).cast(dtype), start)
