"""A case small enough to work out by hand; the window starts on 2023-01-01."""

AS_OF = "2024-07-01"

ADJ_COLUMNS = (
    "transaction_item_id long, adjusted_date string, fnsku string, "
    "fulfillment_center_id string, reason string, disposition string, quantity long"
)
# id, date, product, centre, reason, state, quantity, burst, case1
ADJ_EXPECTED = [
    (1000, "2022-12-31", "X1", "FC1", "P", "WAREHOUSE_DAMAGED", -9, None, None),
    (20000, "2023-01-01", "X1", "FC1", "Q", "UNSELLABLE", -2, 20000, None),
    (25000, "2023-01-05", "X1", "FC1", "P", "SELLABLE", 2, 20000, "Q-UNSELLABLE:P-SELLABLE"),
    (35000, "2023-01-06", "X2", "FC1", "P", "CUSTOMER_DAMAGED", 1, 20000,
     "Q-UNSELLABLE:P-CUSTOMER_DAMAGED"),
    (100000, "2023-02-01", "X2", "FC2", "M", "SELLABLE", -5, 0, None),
    (200000, "2023-02-02", "X1", "FC2", "D", "UNSELLABLE", -3, 200000, None),
    (200500, "2023-02-02", "X1", "FC2", "D", "WAREHOUSE_DAMAGED", -4, 200000, None),
    (300000, "2023-03-01", "X2", "FC1", "M", "WAREHOUSE_DAMAGED", -6, 0, None),
    (320000, "2023-03-02", "X2", "FC1", "F", "WAREHOUSE_DAMAGED", 2, 0, None),
    (400000, "2023-04-01", "X1", "FC1", "O", "SELLABLE", -8, 0, None),
    (500000, "2023-05-01", "X1", "FC1", "P", "UNSELLABLE", 1, 500000, None),
    (500100, "2023-05-01", "X1", "FC1", "Q", "WAREHOUSE_DAMAGED", -1, 500000, None),
    (500200, "2023-05-01", "X1", "FC1", "Q", "SELLABLE", -7, 500000, None),
    (500300, "2023-05-01", "X1", "FC1", "P", "SELLABLE", 4, 500000,
     "Q-WAREHOUSE_DAMAGED:P-SELLABLE"),
]
ADJ = [r[:7] for r in ADJ_EXPECTED]

REI_COLUMNS = (
    "approval_date string, fnsku string, reason string, "
    "quantity_reimbursed_total long, quantity_reimbursed_inventory long"
)
REI = [
    ("2023-02-10", "X1", "Damaged_Warehouse", 5, 0),
    ("2023-03-10", "X2", "Lost_Warehouse", 3, 1),
    ("2023-03-11", "X3", "CustomerReturn", 2, 2),
    ("2022-06-01", "X1", "Lost_Warehouse", 50, 50),
]

REC_COLUMNS = (
    "sku string, fnsku string, asin string, product_name string, condition string, "
    "discrepant_quantity long, quantity long"
)
REC = [
    ("S1", "X1", "B1", "one", "NEW", -2, 0),
    ("S2", "X2", "B2", "two", "NEW", 1, 0),
    ("S4", "X4", "B4", "four", "NEW", 0, 0),
]

REPORT_COLUMNS = [
    "00_fnsku", "disposition", "01_TOTL", "10_LOST", "20_DMG", "05_Tr.OUT_reasn",
    "Disp_reimbrsble", "02_Misplaced", "02_Found", "05_Tr.OUT", "Disposed", "12_Dispsd_sellbl",
    "15_DMG_lost", "17_Regraded_to_sell", "07_Reimb_Loss", "16_Reimb_Dmg", "04_Tr.IN_reasn",
    "02_Discrepancy",
]
REPORT = [
    ("X1", "WAREHOUSE_DAMAGED", -9, -9, 8, 1, -4, 0, 0, -8, -7, -3, 0, 6, 0, 5, 0, -2),
    ("X1", "UNSELLABLE", -8, -8, 8, 2, -3, 0, 0, -8, -7, -3, 0, 6, 0, 5, 0, -2),
    ("X2", None, -6, -6, 5, 0, 0, -11, 2, 0, 0, 0, 4, 1, 3, 0, -1, 1),
    ("X3", None, -2, -2, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, -2, 0),
]


def frames(spark, client=None):
    """The three inputs, with a ``client`` column if one is named."""
    out = []
    for data, ddl in ((REC, REC_COLUMNS), (ADJ, ADJ_COLUMNS), (REI, REI_COLUMNS)):
        df = spark.createDataFrame(data, ddl)
        if client:
            from pyspark.sql import functions as F

            df = df.withColumn("client", F.lit(client))
        out.append(df)
    return out
