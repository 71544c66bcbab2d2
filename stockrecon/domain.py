"""Codes, lists and names that the reports themselves define, plus key helpers.

Everything in the first block is a fixed value: results only come out right if
the lists are exactly these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values ---------------------------------------------------------
HISTORY_MONTHS = 18
MAX_ID_GAP = 10_000

# Stock states.
GOOD_STATES = ["SELLABLE", "DEFECTIVE", "DISTRIBUTOR_DAMAGED", "CUSTOMER_DAMAGED", "EXPIRED"]
BAD_STATES = ["UNSELLABLE", "WAREHOUSE_DAMAGED", "CARRIER_DAMAGED"]
DISPOSITIONS = GOOD_STATES + BAD_STATES

# A bad-state movement in one direction makes good-state movements in the
# opposite direction suspicious.
OPPOSITE_REASON = {"P": "Q", "Q": "P"}

REASONS_1 = ["E", "5", "Damaged_by_FC", "Disposed_of", "M", "Misplaced"]
REASONS_2 = ["F", "N", "O", "1", "2", "D", "G", "I", "K"]
REIMBURSED_REASONS = ["Lost_Warehouse", "Damaged_Warehouse"]
LOST_AFTER_DAMAGE_REASONS = ["M", "F"]
DISPOSED_REASON = "D"
DISPOSED_NOT_REIMBURSABLE = [
    "SELLABLE", "DEFECTIVE", "DISTRIBUTOR_DAMAGED", "UNSELLABLE", "CUSTOMER_DAMAGED",
]
DISPOSED_REIMBURSABLE = ["WAREHOUSE_DAMAGED", "CARRIER_DAMAGED", "UNSELLABLE"]

# Report headings for internal measure names.
REPORT_NAMES = {
    "quantity": "D_Regraded",
    "E": "11_Damaged",
    "D": "Disposed",
    "M": "02_Misplaced",
    "5": "13_Unrecoverable",
    "F": "02_Found",
    "quantity_reimbursed_inventory": "04_Tr.IN_reasn",
    "G": "14_Unexplained",
    "K": "Defect_dmg",
    "N": "03_Tr.IN",
    "O": "05_Tr.OUT",
    "Lost_Warehouse": "07_Reimb_Loss",
    "Damaged_Warehouse": "16_Reimb_Dmg",
    "discrepant_quantity": "02_Discrepancy",
    "fnsku": "00_fnsku",
}

# Drill-down column names; the prefixes make these states sort last.
DRILLDOWN_STATES = {
    "SELLABLE": "Z__SELLABLE",
    "CARRIER_DAMAGED": "Zz_CARRIER_DAMAGED",
    "UNSELLABLE": "Zz_UNSELLABLE",
    "WAREHOUSE_DAMAGED": "Zz_WAREHOUSE_DAMAGED",
}

DRILLDOWN_KEYS = [
    "fnsku", "adjusted_date", "fulfillment_center_id", "transaction_item_id", "tr_id", "reason",
]

# Text of a stock row for a product that only has reimbursements.
PLACEHOLDER_TEXT = {
    "sku": "sku", "asin": "asin", "product_name": "product_name", "condition": "condition",
}

REPORT_KINDS = ["rec", "adj", "rei"]
REPLY_OK = "Macros reply - Ok"
REPLY_NOTHING = "Nothing to do"
NO_SUBJECT = "was_no_subj_"
# --- end of fixed values --------------------------------------------------

# Sums a product gets from adjustments and reimbursements, internal names.
PRODUCT_SUMS = (
    ["17_Regraded_to_sell"]
    + REASONS_1
    + REASONS_2
    + REIMBURSED_REASONS
    + ["quantity_reimbursed_inventory", "15_DMG_lost", "12_Dispsd_sellbl"]
)


def keys_of(df: DataFrame, *names: str) -> list[str]:
    """``names`` preceded by ``client`` when the frame carries it."""
    return (["client"] if "client" in df.columns else []) + list(names)


def measure_columns() -> list[str]:
    """Report headings that decide whether a product has anything to show."""
    internal = PRODUCT_SUMS + [
        "quantity", "discrepant_quantity", "Disp_reimbrsble", "05_Tr.OUT_reasn",
        "10_LOST", "20_DMG", "01_TOTL",
    ]
    return sorted(REPORT_NAMES.get(c, c) for c in internal)
