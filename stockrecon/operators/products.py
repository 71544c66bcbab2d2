"""Sums per product: single aggregates, and all of them in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.domain import (
    DISPOSED_NOT_REIMBURSABLE,
    DISPOSED_REASON,
    DISPOSED_REIMBURSABLE,
    LOST_AFTER_DAMAGE_REASONS,
    PRODUCT_SUMS,
    REASONS_1,
    REASONS_2,
    REIMBURSED_REASONS,
    keys_of,
)

_REASON, _STATE = "reason", "disposition"


def _any_of(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _with_reason(reason: str) -> str:
    return f"{_REASON} = '{reason}'"


# Which rows enter a sum, and what each adds: read by the single aggregates and
# by the one-pass table alike.
_LOST_AFTER_DAMAGE = (
    f"{_STATE} = 'WAREHOUSE_DAMAGED' AND {_any_of(_REASON, LOST_AFTER_DAMAGE_REASONS)}"
)
_NOT_REIMBURSABLE = (
    f"{_with_reason(DISPOSED_REASON)} AND {_any_of(_STATE, DISPOSED_NOT_REIMBURSABLE)}"
)
_REIMBURSABLE = f"{_with_reason(DISPOSED_REASON)} AND {_any_of(_STATE, DISPOSED_REIMBURSABLE)}"
_LOST_UNITS = "-quantity"
_RETURNED_UNITS = "-quantity_reimbursed_inventory"


def _total(value: Column) -> Column:
    """Sum in which nulls, and the absence of any value, count as 0."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def _given(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _grouped(df: DataFrame, *names: str):
    keys = keys_of(df, *names)
    return df.dropna(subset=keys).groupBy(*keys)


def pivot_reasons(df: DataFrame, reasons: list[str], value: str = "quantity") -> DataFrame:
    """One column of summed ``value`` per reason; products with none of them are absent."""
    rows = df.where(_any_of(_REASON, reasons))
    return _grouped(rows, "fnsku").agg(
        *[_total(F.expr(_given(_with_reason(r), value))).alias(r) for r in reasons]
    )


def reason_pivot_1(adj: DataFrame) -> DataFrame:
    return pivot_reasons(adj, REASONS_1)


def reason_pivot_2(adj: DataFrame) -> DataFrame:
    return pivot_reasons(adj, REASONS_2)


def reimbursement_pivot(rei: DataFrame) -> DataFrame:
    return pivot_reasons(rei, REIMBURSED_REASONS, "quantity_reimbursed_total")


def inventory_reimbursed(rei: DataFrame) -> DataFrame:
    """Units given back in kind, over all reasons, negated."""
    return _grouped(rei, "fnsku").agg(
        _total(F.expr(_RETURNED_UNITS)).alias("quantity_reimbursed_inventory")
    )


def damaged_then_lost(adj: DataFrame) -> DataFrame:
    """Lost or found while warehouse-damaged, negated."""
    return _grouped(adj.where(_LOST_AFTER_DAMAGE), "fnsku").agg(
        _total(F.expr(_LOST_UNITS)).alias("15_DMG_lost")
    )


def disposals_sellable(adj: DataFrame) -> DataFrame:
    """Disposals that nobody reimburses."""
    return _grouped(adj.where(_NOT_REIMBURSABLE), "fnsku").agg(
        _total(F.col("quantity")).alias("12_Dispsd_sellbl")
    )


def disposals_reimbursable(adj: DataFrame) -> DataFrame:
    """Disposals open to reimbursement, per product and stock state."""
    return _grouped(adj.where(_REIMBURSABLE), "fnsku", _STATE).agg(
        _total(F.col("quantity")).alias("Disp_reimbrsble")
    )


# --- one pass ---------------------------------------------------------------


def _state_sum(state: str) -> str:
    return f"disposed {state}"


def _state_rows(state: str) -> str:
    return f"disposals {state}"


def _wide_columns() -> list[str]:
    states = [f(s) for s in DISPOSED_REIMBURSABLE for f in (_state_sum, _state_rows)]
    return PRODUCT_SUMS + states + ["rei_rows"]


def _parts(df: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """Rows of one input as addends of the wide product table."""
    none = "CAST(NULL AS BIGINT)"
    return df.selectExpr(*keys, *[f"{values.get(c, none)} AS `{c}`" for c in _wide_columns()])


def product_table(adj: DataFrame, rei: DataFrame, flagged: DataFrame) -> DataFrame:
    """Every sum of every product, one row per product.

    Adjustments, reimbursements and flagged re-grades become addends of one
    grouping, so a single shuffle of map-side partial sums replaces an aggregate
    and a join per measure; a product with very many rows costs no more than
    any other.
    """
    keys = keys_of(adj, "fnsku")
    from_adj = {r: _given(_with_reason(r), "quantity") for r in REASONS_1 + REASONS_2}
    from_adj["15_DMG_lost"] = _given(_LOST_AFTER_DAMAGE, _LOST_UNITS)
    from_adj["12_Dispsd_sellbl"] = _given(_NOT_REIMBURSABLE, "quantity")
    for state in DISPOSED_REIMBURSABLE:
        here = f"{_REIMBURSABLE} AND {_STATE} = '{state}'"
        from_adj[_state_sum(state)] = _given(here, "quantity")
        from_adj[_state_rows(state)] = _given(here, "1L")
    from_rei = {
        r: _given(_with_reason(r), "quantity_reimbursed_total") for r in REIMBURSED_REASONS
    }
    from_rei["quantity_reimbursed_inventory"] = _RETURNED_UNITS
    from_rei["rei_rows"] = "1L"
    parts = [
        _parts(adj.where(_any_of(_REASON, REASONS_1 + REASONS_2)), keys, from_adj),
        _parts(rei, keys, from_rei),
        _parts(flagged, keys, {"17_Regraded_to_sell": "quantity"}),
    ]
    return (
        reduce(DataFrame.union, parts)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(*[F.expr(f"coalesce(sum(`{c}`), 0L) AS `{c}`") for c in _wide_columns()])
    )


def fan_out_disposals(df: DataFrame) -> DataFrame:
    """One row per reimbursable stock state of a product, or one row without state.

    Expects the columns of ``product_table``; they may be null for products
    that have no movements. The states are listed ahead of the explode, which would work
    them out expression by expression, and only for products that have any.
    """
    drop = [f(s) for s in DISPOSED_REIMBURSABLE for f in (_state_sum, _state_rows)]
    cells = [
        F.when(
            F.col(f"`{_state_rows(s)}`") > 0,
            F.struct(
                F.lit(s).alias(_STATE), F.col(f"`{_state_sum(s)}`").alias("Disp_reimbrsble")
            ),
        )
        for s in DISPOSED_REIMBURSABLE
    ]
    disposed = reduce(Column.__or__, [F.col(f"`{_state_rows(s)}`") > 0 for s in DISPOSED_REIMBURSABLE])
    listed = F.when(disposed, F.array_compact(F.array(*cells))).alias("cells")
    keep = [f"`{c}`" for c in df.columns if c not in drop]
    return (
        df.select(*keep, listed).select(*keep, F.explode_outer("cells").alias("cell"))
        .select(*keep, f"cell.{_STATE}", "cell.Disp_reimbrsble")
    )
