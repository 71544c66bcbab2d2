"""Work stays in the task that reads it, and is done once."""

import glob

from golden import AS_OF, frames
from test_files import REC_HEAD, write_folder

from stockrecon import fixtures
from stockrecon.operators.bursts import attach_bursts, burst_buckets
from stockrecon.operators.catalogue import complete_catalogue
from stockrecon.operators.clip import clip_adjustments, clip_reimbursements
from stockrecon.operators.prefilter import may_match
from stockrecon.operators.products import fan_out_disposals, product_table
from stockrecon.operators.regrades import flag_regrades
from stockrecon.operators.skew import join_by, keep_matching, keep_missing
from stockrecon.plans.reconcile import build_report
from stockrecon.sources import sinks
from stockrecon.sources.archives import reports_from_lines
from stockrecon.sources.reports import read_report
from stockrecon.sources.scratch import store


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_of_a_broken_file_are_not_moved(spark, tmp_path):
    """Only parts of records that cross blocks are; before, windows moved every line."""
    body = "".join(f'S{i},X{i},B{i},"two\nlines ""{i}""",NEW,{i},1\n' for i in range(300))
    write_folder(tmp_path, "a", {"x_rec.csv": f'\n{REC_HEAD}\n{body}S,X,B,"open,\n\n1,2'})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = read_report(spark, f"{tmp_path}/*/*", "rec")
        assert "Window" not in _optimized(read)
        got = {r["sku"]: r["product_name"] for r in read.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {**{f"S{i}": f'two\nlines "{i}"' for i in range(300)}, "S": "open,\n\n1,2"}


def test_files_are_written_where_their_rows_are(spark, tmp_path):
    lines = spark.range(0, 900, 1, 3).selectExpr(
        "concat('C', id % 2) AS client", "'x_adj.csv' AS name", "'a,b' AS header",
        "concat(id, ',z') AS line",
    )
    landing = fixtures.drop_files(lines, str(tmp_path))
    found = []
    for client in ("C0", "C1"):
        files = [open(f).read().splitlines() for f in glob.glob(f"{landing}/{client}/*_x_adj.csv")]
        assert len(files) == 3 and all(f[0] == "a,b" and f.count("a,b") == 1 for f in files)
        found += [row for f in files for row in f[1:]]
    assert sorted(found) == sorted(f"{i},z" for i in range(900))


def test_a_record_is_cut_once(spark):
    """A condition on the number of cells used to cut it once more."""
    head = "sku,fnsku,quantity"
    rows = [("c", "a.zip", "x_rec.csv", head, t) for t in ('S1,"X""1",2', "S2,X2", "S3,X3,n/a,", '"S4","X4"x,"5"')]
    lines = spark.createDataFrame(rows, "client string, archive string, name string, header string, line string")
    rec = reports_from_lines(lines)["rec"]
    assert _optimized(rec).count("split(line") == 1
    got = sorted((r["sku"], r["fnsku"], r["quantity"]) for r in rec.collect())
    assert got == [("S1", 'X"1', 2), ("S2", "X2", None), ("S4", "X4x", 5)]


def test_the_catalogue_needs_no_join(spark):
    """One grouping of both reports' keys; the join sorted all of them twice."""
    rec = spark.createDataFrame(
        [("c", "X1", "S1"), ("c", "X1", "S2"), ("d", None, "S3"), (None, "X4", "S4")],
        "client string, fnsku string, sku string",
    )
    rei = spark.createDataFrame(
        [("c", "X1"), ("d", "X1"), ("d", "X1"), ("d", None), (None, "X4"), (None, None)],
        "client string, fnsku string",
    )
    full = complete_catalogue(rec, rei)
    assert "Join" not in _optimized(full)
    placed = full.where("sku = 'sku'").collect()
    assert sorted((r["client"], r["fnsku"]) for r in placed if r["client"]) == [("d", "X1")]
    assert len(placed) == 2 and full.count() == 6


def test_keys_of_stock_are_not_broadcast(spark, tmp_path):
    """Its files are small, its rows are many: the planner only knows of the files."""
    path = str(tmp_path / "parts")
    spark.range(40).write.parquet(path)
    stock = spark.read.parquet(path).selectExpr(
        "explode(sequence(1, 50)) AS client", "concat('X', id) AS fnsku"
    )
    sums = spark.range(42).selectExpr("1 AS client", "concat('X', id) AS fnsku", "id AS n")
    found = keep_missing(sums, stock, ["client", "fnsku"])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["n"] for r in found.collect()) == [40, 41]


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sorts_of_joins_look_at_the_client_last(spark):
    """Rows of one client were told apart by reading them, whatever the other keys are."""
    left = spark.createDataFrame(
        [(1, "c", "X1"), (2, "c", "X2"), (3, None, "X1"), (4, "d", None), (5, "d", "X1")],
        "n long, client string, fnsku string",
    )
    right = spark.createDataFrame(
        [("c", "X1", 7), ("c", "X1", 8), (None, "X1", 9), ("d", None, 9)], "client string, fnsku string, m long"
    )
    keys = ["client", "fnsku"]
    found = keep_matching(left, right, keys)
    assert found.columns == ["client", "fnsku", "n"]
    assert [r["n"] for r in found.collect()] == [1]
    joined = join_by(left, right, keys, "left")
    assert joined.columns == ["client", "fnsku", "n", "m"]
    assert sorted(tuple(r) for r in joined.select("n", "m").na.fill(0).collect()) == [
        (1, 7), (1, 8), (2, 0), (3, 0), (4, 0), (5, 0),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        adj = left.selectExpr("client", "fnsku", "n * 500 AS transaction_item_id", "'P' AS reason",
                              "'SELLABLE' AS disposition")
        for df, first in (
            (keep_matching(left, right, keys), "fnsku"),
            (keep_missing(left, right, keys), "fnsku"),
            (attach_bursts(adj, store(burst_buckets(adj))), "bucket"),
        ):
            assert f"Sort [{first}#" in _planned(df) and "Sort [client#" not in _planned(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stock_and_placeholders_meet_the_sums_in_one_join(spark):
    """Another join looked for placeholders: sums were moved twice, keys of the stock sorted."""
    rec, adj, rei = frames(spark, "acme")
    adj, rei = clip_adjustments(adj, AS_OF), clip_reimbursements(rei, AS_OF)
    report = build_report(rec, adj, rei, burst_buckets(adj), store)
    assert _optimized(report).count("Join ") == 1
    placed = report.where("sku = 'sku'").collect()
    assert [r["00_fnsku"] for r in placed] == ["X3"]


def test_states_are_listed_ahead_of_the_explode(spark):
    rec, adj, rei = frames(spark, "acme")
    sums = store(product_table(adj, rei, flag_regrades(adj, burst_buckets(adj))))
    wide = fan_out_disposals(sums.unionByName(sums.limit(1).selectExpr("client", "'none' AS fnsku"), True))
    assert "Generate explode(cells" in _optimized(wide)
    found = wide.where("fnsku = 'none'").collect()
    assert [(r["disposition"], r["Disp_reimbrsble"]) for r in found] == [(None, None)]


def test_the_written_report_is_joined_once(spark, tmp_path, monkeypatch):
    """Its ordering read the join twice, once for a sample."""
    plans, write = {}, sinks.Run.write

    def spy(self, df, table, by_client=True):
        plans[table] = _planned(df)
        return write(self, df, table, by_client)

    monkeypatch.setattr(sinks.Run, "write", spy)
    written = sinks.write_results(*frames(spark, "acme"), AS_OF, str(tmp_path / "out"))
    below = plans["report"].split("rangepartitioning")[1]
    assert "REBALANCE_PARTITIONS_BY_COL" in below and "Join" in below.split("REBALANCE")[1]
    assert written["df_rec"].count() == 4


def test_the_filter_hashes_a_key_once(spark):
    """The condition of its join did so for every use of the hash."""
    adj = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", 3)], "client string, fnsku string, _n long")
    passed = may_match(adj, adj.where("client = 'a'"), ["client", "fnsku"])
    join = next(line for line in _optimized(passed).splitlines() if "Join" in line)
    assert "xxhash64" not in join
    assert [tuple(r) for r in passed.collect()] == [("a", "x", 1)]
