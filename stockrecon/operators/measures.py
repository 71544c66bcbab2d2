"""Balances per product row, report headings and the non-zero filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import NumericType

from stockrecon.domain import REPORT_NAMES, measure_columns

# The non-zero test reads the columns between these two.
FIRST, LAST = "00_fnsku", "asin"

BALANCES = {
    "05_Tr.OUT_reasn": "least(Damaged_Warehouse + Disp_reimbrsble, -O)",
    "10_LOST": (
        "M + F + Lost_Warehouse + discrepant_quantity + N + quantity_reimbursed_inventory"
        " + O + `05_Tr.OUT_reasn`"
    ),
    "20_DMG": (
        "E + `12_Dispsd_sellbl` + `17_Regraded_to_sell` + K + G + I + Damaged_Warehouse"
        " + `15_DMG_lost` + quantity"
    ),
    "01_TOTL": "least(`10_LOST`, 0L) + least(`20_DMG`, 0L)",
}


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def derive_measures(df: DataFrame) -> DataFrame:
    """Add transfer-out reason, lost, damaged and total balances (internal names).

    Each balance may read the ones before it.
    """
    return df.selectExpr("*", *[f"{sql} AS `{name}`" for name, sql in BALANCES.items()])


def rename_measures(df: DataFrame) -> DataFrame:
    """Report headings, columns in name order."""
    renamed = df.withColumnsRenamed(REPORT_NAMES)
    return renamed.selectExpr(*[f"`{name}`" for name in sorted(renamed.columns)])


def further_counts(df: DataFrame) -> list[str]:
    """Numeric stock columns, beyond the measures, that the non-zero test reads too.

    It reads every number whose name stands between the first column and ``asin``.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return [n for n in names if FIRST < n < LAST and n not in measure_columns()]


def any_nonzero(columns: list[str]) -> str:
    """Condition that one of the columns differs from zero; nulls count as zero."""
    return " OR ".join(f"coalesce(`{c}`, 0) <> 0" for c in columns)


def nonzero_filter(report: DataFrame) -> DataFrame:
    """Rows in which any measure or further stock count differs from zero."""
    return report.where(any_nonzero(measure_columns() + further_counts(report)))


def order_report(report: DataFrame) -> DataFrame:
    """Worst total first within each client.

    The tie-breakers make the order total, so the range shuffle can cut through
    any number of equal totals, even of equal rows.
    """
    first = ["client"] if "client" in report.columns else []
    return report.orderBy(
        *first, _c("01_TOTL"), _c("00_fnsku"), F.desc("disposition"), F.monotonically_increasing_id()
    )
