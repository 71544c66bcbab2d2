"""Drill-down: adjustments of reported products, by stock state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stockrecon.domain import DISPOSITIONS, DRILLDOWN_KEYS, DRILLDOWN_STATES, keys_of
from stockrecon.operators.prefilter import may_match
from stockrecon.operators.skew import keep_matching
from stockrecon.operators.sliced import is_sliced, keep_matching_sliced


def of_reported_products(adj: DataFrame, report: DataFrame, prefilter: bool = False) -> DataFrame:
    """Adjustments whose product is in the report.

    With ``prefilter`` a Bloom filter of the reported products, which should be stored,
    keeps most other adjustments out of the shuffle. Adjustments from a bucketed
    history stay where they are.
    """
    keys = keys_of(adj, "fnsku")
    products = report.withColumnRenamed("00_fnsku", "fnsku").select(*keys)
    if is_sliced(adj):
        return keep_matching_sliced(adj, products, keys)
    if prefilter:
        return keep_matching(may_match(adj, products, keys), products, keys, in_order=True)
    return keep_matching(adj, products, keys)


def recode_dispositions(adj: DataFrame) -> DataFrame:
    """Names under which stock states appear in the drill-down."""
    return adj.replace(DRILLDOWN_STATES, subset=["disposition"])


def drilldown_states() -> list[str]:
    return sorted(DRILLDOWN_STATES.get(d, d) for d in DISPOSITIONS)


def present_states(adj: DataFrame) -> list[str]:
    """Stock states that occur; a short list by nature, one value per column."""
    states = adj.select("disposition").dropna().distinct()
    limit = int(adj.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r[0] for r in states.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(
            f"more than {limit} stock states to show as columns;"
            " crosstab_margins gives them as rows, however many"
        )
    return sorted(found)


def _countable(adj: DataFrame) -> DataFrame:
    """Rows a total may use: every key, the state and the quantity are known."""
    return adj.dropna(subset=keys_of(adj, *DRILLDOWN_KEYS, "disposition", "quantity"))


def _margin_keys(df: DataFrame, margin, client: list[str]) -> list:
    """Key columns with the margin row spelled out: `All`, then blanks."""
    blank = {DRILLDOWN_KEYS[0]: "All"}
    out = list(client)
    for k in DRILLDOWN_KEYS:
        dtype = df.schema[k].dataType
        fill = F.lit(blank.get(k, "") if isinstance(dtype, StringType) else None).cast(dtype)
        out.append(F.when(margin, fill).otherwise(F.col(k)).alias(k))
    return out


def crosstab(adj: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Quantity by the drill-down keys with a column per stock state and totals.

    ``All`` is the row total over every state, also ones without a column; the
    row ``All`` holds column totals per client. Absent cells are null. Pass
    ``present_states(adj)`` for columns that follow the data.

    Detail and totals are two grouping sets of one aggregation: one scan, one
    shuffle of partial sums.
    """
    states = drilldown_states() if states is None else states
    client = keys_of(adj)
    rows = _countable(adj)
    state = F.col("disposition")
    cells = [
        F.sum(F.when(state == s, F.col("quantity"))).alias(s) for s in states
    ]
    every = client + DRILLDOWN_KEYS
    grouped = rows.groupingSets([every, client], *every).agg(
        *cells,
        F.sum("quantity").alias("All"),
        F.grouping(DRILLDOWN_KEYS[0]).alias("margin"),
        F.count("*").alias("rows"),
    )
    # Without a client there is a total row even over nothing; drop it.
    return grouped.where(F.col("rows") > 0).select(
        *_margin_keys(adj, F.col("margin") == 1, client),
        *[F.col(f"`{s}`") for s in states],
        "All",
    )


def crosstab_margins(adj: DataFrame) -> DataFrame:
    """The cross-tab in long form, whatever the states are.

    One row per cell; `disposition` is `All` in row totals, the keys are those
    of the `All` row in column totals, and both in the grand total.
    """
    client = keys_of(adj)
    every = client + DRILLDOWN_KEYS
    rows = _countable(adj)
    grouped = rows.groupingSets(
        [every + ["disposition"], every, client + ["disposition"], client],
        *every,
        "disposition",
    ).agg(
        F.sum("quantity").alias("quantity"),
        F.grouping(DRILLDOWN_KEYS[0]).alias("margin"),
        F.grouping("disposition").alias("row_total"),
        F.count("*").alias("rows"),
    )
    return grouped.where(F.col("rows") > 0).select(
        *_margin_keys(adj, F.col("margin") == 1, client),
        F.when(F.col("row_total") == 1, "All").otherwise(F.col("disposition")).alias("disposition"),
        "quantity",
    )


def pivot_long(adj: DataFrame) -> DataFrame:
    """Summed quantity per drill-down key and stock state, no totals."""
    keys = keys_of(adj, *DRILLDOWN_KEYS, "disposition")
    return _countable(adj).groupBy(*keys).agg(F.sum("quantity").alias("quantity"))


def order_crosstab(table: DataFrame) -> DataFrame:
    """Rows by key, the total row last within each client."""
    return table.orderBy(
        *keys_of(table), (F.col("fnsku") == "All") & F.col("tr_id").isNull(), *DRILLDOWN_KEYS
    )
