"""The same results in plain SQL over the benchmark tables, for cross-checking.

Written measure by measure, with ordered windows and one join per aggregate, so
that it shares no method with the Spark jobs.
"""

from __future__ import annotations

# The code lists, headings and replies below have to be exactly these.
_CYCLE = "['P','Q','E','5','M','F','N','O','D','G','I','K','1','2','D','P','Q','Damaged_by_FC','Disposed_of','Misplaced']"
_STATES = (
    "['SELLABLE','DEFECTIVE','DISTRIBUTOR_DAMAGED','CUSTOMER_DAMAGED','EXPIRED',"
    "'UNSELLABLE','WAREHOUSE_DAMAGED','CARRIER_DAMAGED']"
)
_CUTOFF = "TIMESTAMP '2000-05-04'"

_PARTS: dict[str, str] = {
    "adj_all": f"""
        SELECT 'C' || ((l_orderkey // 4) % 5) AS client,
               CASE WHEN (l_orderkey // 4) % 5 = 4 
                    THEN (l_orderkey * 10 + l_linenumber) * 10000000000 + l_partkey * 20000
                    ELSE l_orderkey * 5000 + l_linenumber * 500 END AS transaction_item_id,
               l_shipdate AS day,
               strftime(l_shipdate, '%Y-%m-%d') AS adjusted_date,
               CASE WHEN NOT (l_orderkey % 41 = 0 AND l_linenumber = 6)
                    THEN 'X' || l_partkey END AS fnsku,
               'FC' || (l_suppkey % 20) AS fulfillment_center_id,
               {_CYCLE}[(l_partkey + 3 * l_linenumber + l_suppkey) % 20 + 1] AS reason,
               CASE WHEN (l_orderkey + l_linenumber) % 37 <> 0
                    THEN {_STATES}[(l_orderkey + 5 * l_linenumber + l_suppkey) % 8 + 1] END
                    AS disposition,
               CASE WHEN (l_partkey + l_linenumber) % 43 = 0 THEN NULL
                    WHEN (l_partkey + l_linenumber) % 3 = 0 THEN CAST(l_quantity AS BIGINT)
                    ELSE -CAST(l_quantity AS BIGINT) END AS quantity
        FROM lineitem""",
    "adj": f"SELECT * EXCLUDE (day) FROM adj_all WHERE day >= {_CUTOFF}",
    "rei_all": """
        SELECT 'C' || ((l_orderkey // 4) % 5) AS client,
               l_shipdate AS day,
               strftime(l_shipdate, '%Y-%m-%d') AS approval_date,
               CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'X' END || l_partkey AS fnsku,
               CASE l_returnflag WHEN 'R' THEN 'Lost_Warehouse'
                    WHEN 'A' THEN 'Damaged_Warehouse'
                    ELSE 'CustomerReturn' END AS reason,
               CAST(l_quantity AS BIGINT) AS quantity_reimbursed_total,
               CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END
                   AS quantity_reimbursed_inventory
        FROM lineitem""",
    "rei": f"SELECT * EXCLUDE (day) FROM rei_all WHERE day >= {_CUTOFF}",
    "rec": """
        SELECT client, 'S' || p_partkey AS sku, 'X' || p_partkey AS fnsku,
               'B' || p_partkey AS asin,
               CASE WHEN p_size % 13 <> 0 THEN p_name END AS product_name, 'NEW' AS condition,
               CAST(CASE WHEN client = 'C5' THEN 0 ELSE p_size - 25 END AS BIGINT)
                   AS discrepant_quantity,
               CAST(CASE WHEN client = 'C5' THEN 0 ELSE p_size % 5 END AS BIGINT) AS quantity,
               CAST(CASE WHEN client <> 'C5' AND p_size = 25 THEN p_partkey % 2 ELSE 0 END
                   AS BIGINT) AS "Ending_count",
               p_type AS store_note
        FROM part, (SELECT unnest(['C0','C1','C2','C3','C4','C5']) AS client)""",
    "cat": """
        SELECT * FROM rec
        UNION ALL
        SELECT DISTINCT client, 'sku', fnsku, 'asin', 'product_name', 'condition',
               CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS VARCHAR)
        FROM rei r
        WHERE NOT EXISTS (SELECT 1 FROM rec s WHERE s.client = r.client AND s.fnsku = r.fnsku)""",
    "steps": """
        SELECT *,
               transaction_item_id - lag(transaction_item_id) OVER w <= 10000 AS follows,
               lead(transaction_item_id) OVER w - transaction_item_id <= 10000 AS leads
        FROM adj WINDOW w AS (PARTITION BY client ORDER BY transaction_item_id)""",
    "firsts": """
        SELECT * EXCLUDE (follows, leads),
               CASE WHEN coalesce(follows, false) THEN NULL
                    WHEN coalesce(leads, false) THEN transaction_item_id ELSE 0 END AS first_id
        FROM steps""",
    # peers share an id: the frame must take all of them, so RANGE and max
    "bursts": """
        SELECT * EXCLUDE (first_id, run_no),
               max(first_id) OVER (PARTITION BY client, run_no) AS tr_id
        FROM (SELECT *, count(first_id) OVER (
                  PARTITION BY client ORDER BY transaction_item_id
                  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no
              FROM firsts)""",
    "cased": "SELECT *, reason || '-' || disposition AS c FROM bursts WHERE tr_id <> 0",
    "last_keys": """
        SELECT client, tr_id, arg_max(c, {'i': transaction_item_id, 'c': c}) AS k
        FROM cased
        WHERE c IN ('Q-UNSELLABLE','Q-WAREHOUSE_DAMAGED','Q-CARRIER_DAMAGED',
                    'P-UNSELLABLE','P-WAREHOUSE_DAMAGED','P-CARRIER_DAMAGED')
        GROUP BY client, tr_id""",
    "flagged": """
        SELECT f.* EXCLUDE (c), k.k || ':' || f.c AS case1
        FROM cased f JOIN last_keys k USING (client, tr_id)
        WHERE f.disposition IN ('SELLABLE','DEFECTIVE','DISTRIBUTOR_DAMAGED',
                                'CUSTOMER_DAMAGED','EXPIRED')
          AND ((k.k LIKE 'Q-%' AND f.reason = 'P') OR (k.k LIKE 'P-%' AND f.reason = 'Q'))""",
    "regraded": """
        SELECT client, fnsku, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS "17_Regraded_to_sell"
        FROM flagged WHERE fnsku IS NOT NULL GROUP BY client, fnsku""",
}


def _pivot(source: str, value: str, codes: list[str]) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum({value}) FILTER (WHERE reason = '{c}'), 0) AS BIGINT) AS \"{c}\""
        for c in codes
    )
    listed = ", ".join(f"'{c}'" for c in codes)
    return (
        f"SELECT client, fnsku, {cells} FROM {source}"
        f" WHERE reason IN ({listed}) AND fnsku IS NOT NULL"
        " GROUP BY client, fnsku"
    )


_G1 = ["E", "5", "Damaged_by_FC", "Disposed_of", "M", "Misplaced"]
_G2 = ["F", "N", "O", "1", "2", "D", "G", "I", "K"]
_G3 = ["Lost_Warehouse", "Damaged_Warehouse"]
_PARTS["p1"] = _pivot("adj", "quantity", _G1)
_PARTS["p2"] = _pivot("adj", "quantity", _G2)
_PARTS["p3"] = _pivot("rei", "quantity_reimbursed_total", _G3)
_PARTS["p4"] = """
    SELECT client, fnsku, CAST(-sum(quantity_reimbursed_inventory) AS BIGINT)
               AS quantity_reimbursed_inventory
    FROM rei GROUP BY client, fnsku"""
_PARTS["p5"] = """
    SELECT client, fnsku, CAST(coalesce(-sum(quantity), 0) AS BIGINT) AS "15_DMG_lost"
    FROM adj
    WHERE disposition = 'WAREHOUSE_DAMAGED' AND reason IN ('M', 'F') AND fnsku IS NOT NULL
    GROUP BY client, fnsku"""
_PARTS["p6"] = """
    SELECT client, fnsku, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS "12_Dispsd_sellbl"
    FROM adj
    WHERE fnsku IS NOT NULL AND reason = 'D' AND disposition IN ('SELLABLE','DEFECTIVE','DISTRIBUTOR_DAMAGED',
                                           'UNSELLABLE','CUSTOMER_DAMAGED')
    GROUP BY client, fnsku"""
_PARTS["p7"] = """
    SELECT client, fnsku, disposition,
           CAST(coalesce(sum(quantity), 0) AS BIGINT) AS "Disp_reimbrsble"
    FROM adj
    WHERE fnsku IS NOT NULL AND reason = 'D' AND disposition IN ('WAREHOUSE_DAMAGED','CARRIER_DAMAGED','UNSELLABLE')
    GROUP BY client, fnsku, disposition"""

_SUMS = (
    ["17_Regraded_to_sell"] + _G1 + _G2 + _G3
    + ["quantity_reimbursed_inventory", "15_DMG_lost", "12_Dispsd_sellbl", "Disp_reimbrsble"]
)
_PARTS["wide"] = f"""
    SELECT cat.*, p7.disposition,
           {", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in _SUMS)}
    FROM cat
    LEFT JOIN regraded USING (client, fnsku)
    LEFT JOIN p1 USING (client, fnsku)
    LEFT JOIN p2 USING (client, fnsku)
    LEFT JOIN p3 USING (client, fnsku)
    LEFT JOIN (SELECT client, fnsku, quantity_reimbursed_inventory FROM p4) p4
           USING (client, fnsku)
    LEFT JOIN p5 USING (client, fnsku)
    LEFT JOIN p6 USING (client, fnsku)
    LEFT JOIN p7 USING (client, fnsku)"""
_PARTS["balanced"] = """
    SELECT *, least("10_LOST", 0) + least("20_DMG", 0) AS "01_TOTL"
    FROM (SELECT *,
                 M + F + "Lost_Warehouse" + discrepant_quantity + N
                   + quantity_reimbursed_inventory + O + "05_Tr.OUT_reasn" AS "10_LOST",
                 E + "12_Dispsd_sellbl" + "17_Regraded_to_sell" + K + G + I
                   + "Damaged_Warehouse" + "15_DMG_lost" + quantity AS "20_DMG"
          FROM (SELECT *, least("Damaged_Warehouse" + "Disp_reimbrsble", -O)
                            AS "05_Tr.OUT_reasn"
                FROM wide))"""
_NAMES = {
    "quantity": "D_Regraded", "E": "11_Damaged", "D": "Disposed", "M": "02_Misplaced",
    "5": "13_Unrecoverable", "F": "02_Found",
    "quantity_reimbursed_inventory": "04_Tr.IN_reasn", "G": "14_Unexplained",
    "K": "Defect_dmg", "N": "03_Tr.IN", "O": "05_Tr.OUT", "Lost_Warehouse": "07_Reimb_Loss",
    "Damaged_Warehouse": "16_Reimb_Dmg", "discrepant_quantity": "02_Discrepancy",
    "fnsku": "00_fnsku",
}
_OTHER = [
    "client", "sku", "asin", "product_name", "condition", "disposition", "store_note",
    "Ending_count", "1", "2", "I",
    "Damaged_by_FC", "Disposed_of", "Misplaced", "12_Dispsd_sellbl", "15_DMG_lost",
    "17_Regraded_to_sell", "Disp_reimbrsble", "05_Tr.OUT_reasn", "10_LOST", "20_DMG", "01_TOTL",
]
_PARTS["named"] = "SELECT " + ", ".join(
    [f'"{c}"' for c in _OTHER] + [f'"{c}" AS "{n}"' for c, n in _NAMES.items()]
) + " FROM balanced"
_TESTED = [
    c for c in _OTHER if c not in (
        "client", "sku", "asin", "product_name", "condition", "disposition", "store_note")
] + [n for n in _NAMES.values() if n != "00_fnsku"]
_PARTS["report"] = (
    "SELECT * FROM named WHERE " + " + ".join(f'abs("{c}")' for c in _TESTED) + " > 0"
)
_RECODE = """CASE disposition WHEN 'SELLABLE' THEN 'Z__SELLABLE'
        WHEN 'CARRIER_DAMAGED' THEN 'Zz_CARRIER_DAMAGED'
        WHEN 'UNSELLABLE' THEN 'Zz_UNSELLABLE'
        WHEN 'WAREHOUSE_DAMAGED' THEN 'Zz_WAREHOUSE_DAMAGED'
        ELSE disposition END AS disposition"""
_PARTS["drill"] = f"""
    SELECT b.* REPLACE ({_RECODE})
    FROM bursts b
    WHERE EXISTS (SELECT 1 FROM report r WHERE r.client = b.client AND r."00_fnsku" = b.fnsku)"""
_PARTS["counted"] = "SELECT * FROM drill WHERE disposition IS NOT NULL AND quantity IS NOT NULL"

_KEYS = "fnsku, adjusted_date, fulfillment_center_id, transaction_item_id, tr_id, reason"
_MARGIN = (
    "'All' AS fnsku, '' AS adjusted_date, '' AS fulfillment_center_id,"
    " CAST(NULL AS BIGINT) AS transaction_item_id, CAST(NULL AS BIGINT) AS tr_id, '' AS reason"
)
_COLUMNS = [
    "CUSTOMER_DAMAGED", "DEFECTIVE", "DISTRIBUTOR_DAMAGED", "EXPIRED",
    "Z__SELLABLE", "Zz_CARRIER_DAMAGED", "Zz_UNSELLABLE", "Zz_WAREHOUSE_DAMAGED",
]
_CELLS = ", ".join(
    f"CAST(sum(quantity) FILTER (WHERE disposition = '{c}') AS BIGINT) AS \"{c}\""
    for c in _COLUMNS
)
_QTY = "CAST(sum(quantity) AS BIGINT)"
_CROSSTAB = (
    f'SELECT client, {_KEYS}, {_CELLS}, {_QTY} AS "All" FROM counted GROUP BY client, {_KEYS}'
    f' UNION ALL SELECT client, {_MARGIN}, {_CELLS}, {_QTY} AS "All" FROM counted GROUP BY client'
)
_LONG = (
    f"SELECT client, {_KEYS}, disposition, {_QTY} AS quantity FROM counted"
    f" GROUP BY client, {_KEYS}, disposition"
)
_MARGINS = (
    _LONG
    + f" UNION ALL SELECT client, {_KEYS}, 'All', {_QTY} FROM counted GROUP BY client, {_KEYS}"
    + f" UNION ALL SELECT client, {_MARGIN}, disposition, {_QTY} FROM counted"
      " GROUP BY client, disposition"
    + f" UNION ALL SELECT client, {_MARGIN}, 'All', {_QTY} FROM counted GROUP BY client"
)

_ORDER = list(_PARTS)


def _needs(sql: str, name: str) -> bool:
    import re

    return re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql) is not None


def with_parts(sql: str) -> str:
    """Prefix ``sql`` with the named parts it uses, directly or not."""
    used: list[str] = []
    pending = sql
    for name in reversed(_ORDER):
        if _needs(pending, name):
            used.insert(0, name)
            pending += " " + _PARTS[name]
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n]})" for n in used) + "\n" + sql


_OUTCOME = """
    SELECT client,
           coalesce(r.n, 0) AS report_rows, coalesce(t.n, 0) AS table_rows,
           coalesce(d.n, 0) AS adjustment_rows,
           CASE WHEN coalesce(r.n, 0) > 0 AND coalesce(t.n, 0) > 0 AND coalesce(d.n, 0) > 0
                THEN 'Macros reply - Ok' ELSE 'Nothing to do' END AS outcome
    FROM (SELECT DISTINCT client FROM rec) c
    LEFT JOIN (SELECT client, count(*) AS n FROM report GROUP BY client) r USING (client)
    LEFT JOIN (SELECT client, count(*) AS n FROM (CROSSTAB) GROUP BY client) t USING (client)
    LEFT JOIN (SELECT client, count(*) AS n FROM drill GROUP BY client) d USING (client)
""".replace("CROSSTAB", _CROSSTAB)


_STATEMENTS: dict[str, str] = {
    "cutoff_adjustments": "SELECT * FROM adj",
    "cutoff_reimbursements": "SELECT * FROM rei",
    "cutoff_opening_date":
        "SELECT * EXCLUDE (day) FROM adj_all WHERE day >= TIMESTAMP '2001-02-01'",
    "complete_catalogue": "SELECT * FROM cat",
    "assign_bursts": "SELECT * FROM bursts",
    "assign_bursts_window": "SELECT * FROM bursts",
    "detect_regrades": "SELECT * FROM flagged",
    "regrade_sums": "SELECT * FROM regraded",
    "reason_pivot_1": "SELECT * FROM p1",
    "reason_pivot_2": "SELECT * FROM p2",
    "reimb_pivot": "SELECT * FROM p3",
    "inventory_reimb": "SELECT * FROM p4",
    "dmg_lost": "SELECT * FROM p5",
    "disposals_sellable": "SELECT * FROM p6",
    "disposals_reimbursable": "SELECT * FROM p7",
    "measures": "SELECT * FROM balanced",
    "report_names": "SELECT * FROM named",
    "nonzero_filter": "SELECT * FROM report",
    "report": "SELECT * FROM report",
    "report_gated":
        "SELECT * FROM report WHERE client IN (SELECT client FROM bursts WHERE tr_id <> 0)",
    "reported_adjustments": """
        SELECT a.* FROM adj a WHERE EXISTS (
            SELECT 1 FROM report r WHERE r.client = a.client AND r."00_fnsku" = a.fnsku)""",
    "history_report": "SELECT * FROM report",
    "history_grown": "SELECT * FROM report",
    "history_adjustments": "SELECT * FROM drill",
    "adj_filtered": "SELECT * FROM drill",
    "disposition_recode": f"SELECT * REPLACE ({_RECODE}) FROM adj",
    "crosstab": _CROSSTAB,
    "crosstab_present_states": _CROSSTAB,
    "crosstab_empty": f"SELECT * FROM ({_CROSSTAB}) WHERE false",
    "crosstab_margins": _MARGINS,
    "pivot_long": _LONG,
    "package_outcome": _OUTCOME,
    "client_key": """
        SELECT conv_id, turn,
               CASE WHEN word = '' THEN 'was_no_subj_' ELSE word END AS client
        FROM (SELECT conv_id, turn,
                     regexp_extract(replace(replace(subject, 'Re:', ''), 'Fwd:', ''),
                                    '[^\\s\\x1c-\\x1f\\x0b\\x85\\p{Z}]+') AS word
              FROM (SELECT conv_id, turn,
                           CASE turn % 4 WHEN 0 THEN 'Re: ' WHEN 1 THEN 'Fwd: Re:' ELSE '' END
                             || CASE WHEN conv_id % 5 = 0 THEN '  ' ELSE text END AS subject
                    FROM conversations))""",
    "report_status": """
        SELECT client, rec_files, adj_files, rei_files,
               CASE WHEN rec_files = 0 THEN 'no file for rec'
                    WHEN rec_files > 1 THEN 'several files for rec'
                    WHEN adj_files = 0 THEN 'no file for adj'
                    WHEN adj_files > 1 THEN 'several files for adj'
                    WHEN rei_files = 0 THEN 'no file for rei'
                    WHEN rei_files > 1 THEN 'several files for rei'
                    ELSE 'ok' END AS status
        FROM (SELECT p_brand || ' ' || p_type || p_size AS client,
                     count(*) FILTER (WHERE p_size % 4 = 0) AS rec_files,
                     count(*) FILTER (WHERE p_size % 4 = 1) AS adj_files,
                     count(*) FILTER (WHERE p_size % 4 = 2) AS rei_files
              FROM part GROUP BY client)""",
    "name_clients": """
        SELECT package, subject,
               CASE WHEN nth = 1 THEN segment
                    ELSE segment || strftime(arrived, '_%y%m%d_%H%M%S')
                         || CASE WHEN again > 1 THEN '_' || again ELSE '' END END AS client
        FROM (SELECT *, row_number() OVER (PARTITION BY segment, arrived, nth = 1
                                           ORDER BY package) AS again
              FROM (SELECT o_orderkey AS package, o_orderdate AS arrived, c_mktsegment AS segment,
                           CASE o_orderkey % 3 WHEN 0 THEN 'Re: ' WHEN 1 THEN 'Fwd: Re:' ELSE '' END
                             || c_mktsegment || ' report' AS subject,
                           row_number() OVER (PARTITION BY c_mktsegment
                                              ORDER BY o_orderdate, o_orderkey) AS nth
                    FROM orders JOIN customer ON o_custkey = c_custkey))""",
    "report_lines": """
        SELECT client, adjusted_date, fnsku, fulfillment_center_id, reason, disposition,
               transaction_item_id, quantity,
               'a, "b"' || chr(10) || fulfillment_center_id AS note
        FROM adj_all""",
    "report_lines_rec": "SELECT * FROM rec",
    "report_lines_rei": """
        SELECT client, approval_date, fnsku, reason, quantity_reimbursed_total,
               quantity_reimbursed_inventory FROM rei_all""",
    "overlong_rows": """
        SELECT client, adjusted_date, fnsku, fulfillment_center_id, reason, disposition,
               transaction_item_id, quantity
        FROM adj_all WHERE transaction_item_id // 500 % 5 = 0""",
    "read_folder": """
        SELECT client, adjusted_date, fnsku, fulfillment_center_id, reason, disposition,
               transaction_item_id, quantity, 'at ' || fulfillment_center_id AS note
        FROM adj_all""",
    "stray_quotes": """
        SELECT client, adjusted_date, fnsku, fulfillment_center_id, reason, disposition,
               transaction_item_id, quantity,
               notes[CAST(place % 5 AS INTEGER) + 1] AS first_note,
               notes[CAST((place + 1) % 5 AS INTEGER) + 1] AS last_note
        FROM (SELECT *, transaction_item_id // 500 AS place,
                     ['5" pipe', 'a, "b"' || chr(10) || 'c', 'say ""twice""', 'end 6"',
                      'closed then "open'] AS notes
              FROM adj_all)""",
    "unparsed_cells": """
        SELECT client, 'adj' AS kind, count(*) AS rows,
               count(*) FILTER (WHERE transaction_item_id // 500 % 7 = 5) AS skipped_rows,
               count(*) FILTER (WHERE transaction_item_id // 500 % 7 IN (1, 2, 3)) AS unparsed_cells
        FROM adj_all GROUP BY client""",
    "written_report": "SELECT * FROM report",
    "burst_totals": """
        SELECT client, tr_id, max(transaction_item_id) AS last_id, count(*) AS adjustments,
               CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity
        FROM bursts WHERE tr_id <> 0 GROUP BY client, tr_id""",
    "package_status": """
        SELECT 'C' || pack AS client, 'p' || pack || '.zip' AS archive,
               CASE pack % 6 WHEN 1 THEN 'not ZIP file attached'
                    WHEN 2 THEN 'p' || pack || '.zip - brocken *.zip'
                    ELSE CASE WHEN pack % 6 IN (0, 5) AND n = 3 THEN 'ok'
                              ELSE 'not three files in ZIP' END END AS status
        FROM (SELECT p_partkey // 3 AS pack, count(*) AS n FROM part GROUP BY pack)""",
    "allow_list": """
        SELECT c_custkey, n_name AS sender
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE n_name IN (SELECT n_name FROM nation WHERE n_regionkey IN (0, 2))""",
}


def statements() -> dict[str, str]:
    return {name: with_parts(sql) for name, sql in _STATEMENTS.items()}
