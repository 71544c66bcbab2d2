"""Declared schemas of the three reports."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType


def _schema(text: list[str], numbers: list[str]) -> StructType:
    return StructType(
        [StructField(c, StringType()) for c in text]
        + [StructField(c, LongType()) for c in numbers]
    )


REC = _schema(
    ["client", "sku", "fnsku", "asin", "product_name", "condition"],
    ["discrepant_quantity", "quantity"],
)
ADJ = _schema(
    ["client", "adjusted_date", "fnsku", "fulfillment_center_id", "reason", "disposition"],
    ["transaction_item_id", "quantity"],
)
REI = _schema(
    ["client", "approval_date", "fnsku", "reason"],
    ["quantity_reimbursed_total", "quantity_reimbursed_inventory"],
)

REPORT_SCHEMAS = {"rec": REC, "adj": ADJ, "rei": REI}
