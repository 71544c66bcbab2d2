"""The whole reconciliation as one lazy plan per result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from stockrecon.domain import (
    PRODUCT_SUMS,
    REPLY_NOTHING,
    REPLY_OK,
    keys_of,
    measure_columns,
)
from stockrecon.operators.bursts import attach_bursts, burst_buckets
from stockrecon.operators.catalogue import complete_catalogue, placeholder_value
from stockrecon.operators.clip import clip_adjustments, clip_reimbursements
from stockrecon.operators.crosstab import (
    crosstab,
    of_reported_products,
    order_crosstab,
    recode_dispositions,
)
from stockrecon.operators.measures import (
    any_nonzero,
    derive_measures,
    further_counts,
    order_report,
    rename_measures,
)
from stockrecon.operators.products import fan_out_disposals, product_table
from stockrecon.operators.regrades import flag_regrades
from stockrecon.operators.skew import join_by, keep_matching, keep_missing
from stockrecon.operators.sliced import SLICE, is_sliced, per_slice
from stockrecon.sources.history import put_sums
from stockrecon.sources.scratch import Shelf, store


ROW_QUANTITIES = ["discrepant_quantity", "quantity", "Disp_reimbrsble"]


def with_own_names(rec: DataFrame) -> DataFrame:
    """Rename further stock columns that differ from a measure only in case.

    Column names are compared without case, so a stock count `misplaced` would
    collide with the sum `Misplaced`; it becomes `misplaced_rec`.
    """
    measures = {c.lower() for c in PRODUCT_SUMS + measure_columns() + ["disposition"]}
    clashes = {c: f"{c}_rec" for c in rec.columns if c.lower() in measures}
    return rec.withColumnsRenamed(clashes)


def with_optional_counts(rec: DataFrame) -> DataFrame:
    """Stock columns the balances read, 0 where the report lacks them."""
    missing = [c for c in ("discrepant_quantity", "quantity") if c not in rec.columns]
    return rec.withColumns({c: F.lit(0).cast("long") for c in missing})


def _branches(rec: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stock rows with their product sums, and placeholders of products without one.

    A product without a stock row becomes a placeholder if it has reimbursements.
    Every stock row of a repeated product gets the full sums. Sums that are missing
    are null. Stock from a bucketed history stays where it is and the sums come once
    per slice; they do so already where they were stored for it.
    """
    keys = keys_of(rec, "fnsku")
    if is_sliced(rec):
        sums = products if is_sliced(products) else per_slice(products, rec)
        stocked = rec.join(sums, [*keys, SLICE], "left").drop(SLICE)
        rec = rec.drop(SLICE)
        if is_sliced(products):
            products = products.where(F.col(SLICE) == "0").drop(SLICE)
    else:
        stocked = join_by(rec, products, keys, "left")
    missing = keep_missing(products.where("rei_rows > 0"), rec, keys)
    placeholders = missing.select(
        *[F.col(f.name) if f.name in keys else placeholder_value(f).alias(f.name)
          for f in rec.schema],
        *[f"`{c}`" for c in products.columns if c not in keys],
    )
    return stocked.drop("rei_rows"), placeholders.drop("rei_rows")


def _completed(rec: DataFrame, products: DataFrame) -> DataFrame:
    """``_branches`` as one frame, for stored sums and stock that is shuffled anyway.

    The keys of both are grouped once to find the placeholders, which meet the sums together
    with the stock: sums are moved and sorted once, and keys are not sorted by themselves.
    """
    full = complete_catalogue(rec, products.where("rei_rows > 0"))
    return join_by(full, products, keys_of(rec, "fnsku"), "left").drop("rei_rows")


def _prepared(rec: DataFrame) -> tuple[DataFrame, list[str]]:
    """Stock with the columns that sums need, and its number columns."""
    rec = with_own_names(with_optional_counts(rec))
    return rec, [f.name for f in rec.schema if isinstance(f.dataType, NumericType)]


def product_rows(rec: DataFrame, products: DataFrame) -> DataFrame:
    """Stock rows and placeholders with their product sums, internal names."""
    rec, numbers = _prepared(rec)
    stocked, placeholders = _branches(rec, products)
    return stocked.unionByName(placeholders).fillna(0, subset=numbers + PRODUCT_SUMS)


def balanced_rows(rec: DataFrame, products: DataFrame) -> DataFrame:
    """Stock rows, one per reimbursable disposal state, with sums and balances."""
    rows = fan_out_disposals(product_rows(rec, products))
    return derive_measures(rows.fillna(0, subset=["Disp_reimbrsble"]))


def build_report(
    rec: DataFrame, adj: DataFrame, rei: DataFrame, buckets: DataFrame,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df, shelf: Shelf | None = None,
) -> DataFrame:
    """Per-product report from clipped inputs and the burst buckets of ``adj``.

    ``keep`` may store the product sums, which are read for the placeholders and for the
    sums themselves; stored, they come to the joins straight from a shuffle, which is what
    lets adaptive execution split a product with very many stock rows. For stock from a
    bucketed history, ``shelf`` may store them in the buckets of the stock instead.

    Balances are zero when every quantity under them is, so the non-zero test
    looks at one flag per product and the row's own quantities. It comes before the
    columns are filled and renamed, and in each branch by itself: the optimizer
    restates a condition for every filled or renamed column in it.
    """
    products = product_table(adj, rei, flag_regrades(adj, buckets)).withColumn(
        "moved", F.expr(any_nonzero(PRODUCT_SUMS))
    )
    if shelf and is_sliced(rec):
        products = put_sums(products, rec, shelf.place())
    else:
        products = keep(products)
    rec, numbers = _prepared(rec)
    own = any_nonzero(ROW_QUANTITIES + further_counts(rec))
    filled = numbers + PRODUCT_SUMS + ["Disp_reimbrsble"]
    found = _branches(rec, products) if is_sliced(rec) else [_completed(rec, products)]
    parts = [
        rename_measures(
            derive_measures(
                fan_out_disposals(part).where(f"coalesce(moved, false) OR {own}").drop("moved")
                .fillna(0, subset=filled)
            )
        )
        for part in found
    ]
    return reduce(DataFrame.unionByName, parts)


def with_bursts_only(df: DataFrame, buckets: DataFrame) -> DataFrame:
    """Drop clients none of whose adjustments form a burst."""
    keys = keys_of(df)
    if keys:
        return keep_matching(df, buckets, keys)
    one = F.lit(1).alias("any_burst")
    tagged = keep_matching(df.select("*", one), buckets.select(one), ["any_burst"])
    return tagged.drop("any_burst")


def drill_down(
    adj: DataFrame, report: DataFrame, buckets: DataFrame, prefilter: bool = False
) -> DataFrame:
    """Adjustments of reported products with ``tr_id`` and drill-down state names.

    ``prefilter`` is for a stored report, see ``of_reported_products``.
    """
    reported = of_reported_products(adj, report, prefilter)
    return recode_dispositions(attach_bursts(reported, buckets))


def reconcile(
    rec: DataFrame,
    adj: DataFrame,
    rei: DataFrame,
    as_of: dt.date | str,
    opening: dt.date | str | None = None,
    *,
    gate_on_bursts: bool = False,
    ordered: bool = True,
    store_shared: bool = True,
) -> dict[str, DataFrame]:
    """Report (``df_rec``), cross-tab (``table``) and its rows (``df_adj_filtered``).

    ``as_of`` is the day the history window counts back from. With
    ``gate_on_bursts`` a client without any burst gets no results at all.
    The parts that the results share are computed now, once, into the checkpoint
    folder; with ``store_shared=False`` everything is lazy and results that are
    read separately repeat the shared work.
    ``stockrecon.sources.sinks.write_results`` does the same with the result
    tables themselves.
    """
    keep = store if store_shared else lambda df: df
    adj = clip_adjustments(adj, as_of, opening)
    rei = clip_reimbursements(rei, as_of, opening)
    buckets = keep(burst_buckets(adj))
    shelf = Shelf(adj.sparkSession) if store_shared and is_sliced(rec) else None
    report = build_report(rec, adj, rei, buckets, keep, shelf)
    if gate_on_bursts:
        report = with_bursts_only(report, buckets)
    report = keep(report)
    rows = keep(drill_down(adj, report, buckets, prefilter=store_shared))
    table = crosstab(rows)
    if ordered:
        report, table = order_report(report), order_crosstab(table)
    return {"df_rec": report, "table": table, "df_adj_filtered": rows}


def package_outcome(clients: DataFrame | None, results: dict[str, DataFrame]) -> DataFrame:
    """Reply per client: ok if report, cross-tab and its rows all have content.

    ``clients`` lists who handed in a package (repeats are fine). Without it the
    results are one client's and get one reply.
    """
    names = {"df_rec": "report_rows", "table": "table_rows", "df_adj_filtered": "adjustment_rows"}
    keys = [] if clients is None else ["client"]
    parts = [results[part].select(*keys, F.lit(part).alias("part")) for part in names]
    if keys:
        parts.append(clients.select(*keys, F.lit(None).cast("string").alias("part")))
    counted = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
        *[F.count_if(F.col("part") == part).alias(name) for part, name in names.items()]
    )
    complete = F.least(*names.values()) > 0
    return counted.withColumn(
        "outcome", F.when(complete, REPLY_OK).otherwise(REPLY_NOTHING)
    )
