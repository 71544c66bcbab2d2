
from __future__ import annotations

import importlib.util
import os
import sys
import tempfile
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from stockrecon import fixtures
from stockrecon.functions.text import client_key
from stockrecon.operators import bursts, catalogue, clip, crosstab, measures, products, regrades
from stockrecon.plans import reconcile as plan
from stockrecon.sources import archives, history, packages, reports, sinks
from stockrecon.sources.scratch import ensure_checkpoint_dir, store

SMOKE_DIR = "/root/testdata/sf0.001"


def _with_folder(query: Callable) -> Callable:
    """A local session without a checkpoint folder gets one; clusters must name theirs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local["):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="stockrecon-"))
        return query(spark, sf_dir)

    return run


def _llm() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the corpus operators, where that subpackage is installed."""
    found: dict[str, Callable] = {}
    twins: dict[str, str] = {}
    if _has("stockrecon.llm") and _has("stockrecon.llm.registry"):
        from stockrecon.llm import registry

        found |= registry.queries()
        twins |= registry.oracle_sql()
        if _has("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, twins


def _has(module: str) -> bool:
    return importlib.util.find_spec(module) is not None


def _iso(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def _adj(spark: SparkSession, sf_dir: str, opening: str | None = None) -> DataFrame:
    """Clipped on the stored timestamp, so the filter reaches the scan; then ISO text."""
    rows = fixtures.adjustments(spark, sf_dir)
    return _iso(clip.clip_adjustments(rows, fixtures.AS_OF, opening), "adjusted_date")


def _rei(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.reimbursements(spark, sf_dir)
    return _iso(clip.clip_reimbursements(rows, fixtures.AS_OF), "approval_date")


def _balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    adj = _adj(spark, sf_dir)
    flagged = regrades.flag_regrades(adj, store(bursts.burst_buckets(adj)))
    table = products.product_table(adj, _rei(spark, sf_dir), flagged)
    return plan.balanced_rows(fixtures.stock(spark, sf_dir), table)


def _report(
    spark: SparkSession, sf_dir: str, gate_on_bursts: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report, clipped adjustments and their stored burst buckets."""
    adj = _adj(spark, sf_dir)
    buckets = store(bursts.burst_buckets(adj))
    rec, rei = fixtures.stock(spark, sf_dir), _rei(spark, sf_dir)
    report = plan.build_report(rec, adj, rei, buckets, store)
    if gate_on_bursts:
        report = plan.with_bursts_only(report, buckets)
    return report, adj, buckets


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, adj, buckets = _report(spark, sf_dir)
    return store(plan.drill_down(adj, report, buckets))


def _reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments of reported products, the others held back by a Bloom filter."""
    report, adj, _ = _report(spark, sf_dir)
    return crosstab.of_reported_products(adj, store(report), prefilter=True)


def _from_history(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Results over stock and adjustments that were landed bucketed by product."""
    path = f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}"
    rec = history.land_history(fixtures.stock(spark, sf_dir), f"{path}/rec")
    adj = history.land_history(_iso(fixtures.adjustments(spark, sf_dir), "adjusted_date"), f"{path}/adj")
    return plan.reconcile(rec, adj, _rei(spark, sf_dir), fixtures.AS_OF)


def _grown_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over stock and adjustments that came in three landings each."""
    path = f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}"
    adj = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    parts = {"rec": fixtures.stock(spark, sf_dir), "adj": adj}
    for name, rows in parts.items():
        part = F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]), F.lit(3))
        history.land_history(rows.where(part == 0), f"{path}/{name}")
        for i in (1, 2):
            history.add_to_history(rows.where(part == i), f"{path}/{name}")
    rec, adj = (history.open_history(spark, f"{path}/{name}") for name in parts)
    return plan.reconcile(rec, adj, _rei(spark, sf_dir), fixtures.AS_OF)["df_rec"]


def _outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = fixtures.stock(spark, sf_dir)
    results = plan.reconcile(
        rec,
        _adj(spark, sf_dir),
        _rei(spark, sf_dir),
        fixtures.AS_OF,
        ordered=False,
        store_shared=True,
    )
    return plan.package_outcome(rec.select("client"), results)


def _allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = fixtures.table(spark, sf_dir, "nation")
    mail = (
        fixtures.table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("sender"))
    )
    listed = nation.where(F.col("n_regionkey").isin(0, 2)).select(
        F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("sender")
    )
    return packages.allowed_only(mail, listed).select("c_custkey", "sender")


def _stock_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names made from parts: brands as clients, sizes as report kinds."""
    kind = F.get(
        F.array(*map(F.lit, ["REC", "adj", "rei", "notes"])), (F.col("p_size") % 4).cast("int")
    )
    files = fixtures.table(spark, sf_dir, "part").select(
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type"), F.col("p_size")).alias("client"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("_"), kind, F.lit(".CSV")).alias(
            "name"
        ),
    )
    return packages.report_status(files)


def _mail_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as mail: the customer's segment is the subject, with reply marks."""
    mark = (
        F.when(F.col("o_orderkey") % 3 == 0, "Re: ")
        .when(F.col("o_orderkey") % 3 == 1, "Fwd: Re:")
        .otherwise("")
    )
    customer = fixtures.table(spark, sf_dir, "customer")
    mail = (
        fixtures.table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("package"),
            F.concat(mark, "c_mktsegment", F.lit(" report")).alias("subject"),
            F.col("o_orderdate").alias("arrived"),
        )
    )
    return packages.name_clients(mail).select("package", "subject", "client")


def _reread(lines: DataFrame, kind: str, **options) -> DataFrame:
    return archives.reports_from_lines(store(lines), **options)[kind]


def _report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments as CSV text in two layouts, with commas, quotes and line breaks."""
    rows = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    note = F.concat(F.lit('a, "b"\n'), "fulfillment_center_id")
    rows = rows.withColumn("note", note)
    plain = rows.withColumn("note", fixtures.csv_cell(F.col("note"), True))
    turned = F.col("client").isin("C0", "C2")
    lines = fixtures.csv_lines(rows.where(turned), "x_adj.csv", turned).unionByName(
        fixtures.csv_lines(plain.where(~turned), "x_adj.csv", turned)
    )
    return _reread(lines, "adj")


def _report_lines_rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.stock(spark, sf_dir)
    lines = fixtures.csv_lines(rows, "x_rec.csv", F.col("client") == "C1")
    read = _reread(lines, "rec", count_columns=("Ending_count",))
    return read.withColumn("Ending_count", F.col("Ending_count").cast("long"))


def _report_lines_rei(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _iso(fixtures.reimbursements(spark, sf_dir), "approval_date")
    return _reread(fixtures.csv_lines(rows, "x_rei.csv", F.col("client") == "C2"), "rei")


def _landing(lines: DataFrame) -> str:
    """Lines written as CSV files of clients, in the shared folder."""
    spark = lines.sparkSession
    return fixtures.drop_files(lines, f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}")


def _read_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments by way of files in two layouts, all cells of one of them quoted."""
    rows = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    rows = rows.withColumn("note", F.concat(F.lit("at "), "fulfillment_center_id"))
    turned = F.col("client").isin("C0", "C2")
    return reports.read_report(
        spark, f"{_landing(fixtures.csv_lines(rows, 'x_adj.csv', turned))}/*/*", "adj"
    )


def _stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    return reports.read_report(spark, f"{_landing(fixtures.with_odd_notes(rows))}/*/*", "adj")


def _unparsed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    landing = _landing(fixtures.with_unparsed_cells(rows))
    return reports.report_losses(reports.raw_rows(spark, f"{landing}/*/*", "adj")[0], "adj")


def _written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a committed run, read back."""
    out = f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    rec, adj, rei = fixtures.stock(spark, sf_dir), _adj(spark, sf_dir), _rei(spark, sf_dir)
    sinks.write_results(rec, adj, rei, fixtures.AS_OF, out, run="r1")
    return sinks.read_results(spark, out, "report").drop("run")


def _overlong_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments of which four in five have surplus cells: some, blank ones, very many."""
    rows = _iso(fixtures.adjustments(spark, sf_dir), "adjusted_date")
    turn = F.expr("transaction_item_id div 500 % 5")
    extra = (
        F.when(turn == 1, ",more").when(turn == 2, ",,,").when(turn == 3, "," * 20 + "9")
        .when(turn == 4, ",").otherwise("")
    )
    return _reread(fixtures.csv_lines(rows, "x_adj.csv", F.col("client") == "C1", extra), "adj")


def _client_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as subject lines, with reply marks, some of them blank."""
    mark = (
        F.when(F.col("turn") % 4 == 0, "Re: ").when(F.col("turn") % 4 == 1, "Fwd: Re:")
        .otherwise("")
    )
    words = F.when(F.col("conv_id") % 5 == 0, "  ").otherwise(F.col("text"))
    return fixtures.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", client_key(F.concat(mark, words)).alias("client")
    )


def entry(spark: SparkSession) -> DataFrame:
    """Ranked report of every client, worst balance first."""
    return queries()["report"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_adj(op):
        return lambda spark, sf: op(_adj(spark, sf))

    def on_rei(op):
        return lambda spark, sf: op(_rei(spark, sf))

    def on_rows(op):
        return lambda spark, sf: op(_rows(spark, sf))

    found = {
        "cutoff_adjustments": _adj,
        "cutoff_reimbursements": _rei,
        "cutoff_opening_date": lambda spark, sf: _adj(spark, sf, "2001-02-01"),
        "complete_catalogue": lambda spark, sf: catalogue.complete_catalogue(
            fixtures.stock(spark, sf), _rei(spark, sf)
        ),
        "assign_bursts": on_adj(bursts.assign_bursts),
        "assign_bursts_window": on_adj(bursts.assign_bursts_window),
        "burst_totals": on_adj(bursts.burst_totals),
        "detect_regrades": on_adj(regrades.detect_regrades),
        "regrade_sums": on_adj(lambda adj: regrades.regrade_sums(regrades.detect_regrades(adj))),
        "reason_pivot_1": on_adj(products.reason_pivot_1),
        "reason_pivot_2": on_adj(products.reason_pivot_2),
        "reimb_pivot": on_rei(products.reimbursement_pivot),
        "inventory_reimb": on_rei(products.inventory_reimbursed),
        "dmg_lost": on_adj(products.damaged_then_lost),
        "disposals_sellable": on_adj(products.disposals_sellable),
        "disposals_reimbursable": on_adj(products.disposals_reimbursable),
        "measures": _balanced,
        "report_names": lambda spark, sf: measures.rename_measures(_balanced(spark, sf)),
        "nonzero_filter": lambda spark, sf: measures.nonzero_filter(
            measures.rename_measures(_balanced(spark, sf))
        ),
        "report": lambda spark, sf: measures.order_report(_report(spark, sf)[0]),
        "report_gated": lambda spark, sf: _report(spark, sf, gate_on_bursts=True)[0],
        "reported_adjustments": _reported,
        "history_report": lambda spark, sf: _from_history(spark, sf)["df_rec"],
        "history_adjustments": lambda spark, sf: _from_history(spark, sf)["df_adj_filtered"],
        "history_grown": _grown_history,
        "adj_filtered": _rows,
        "disposition_recode": on_adj(crosstab.recode_dispositions),
        "crosstab": on_rows(lambda rows: crosstab.order_crosstab(crosstab.crosstab(rows))),
        "crosstab_present_states": on_rows(
            lambda rows: crosstab.crosstab(rows, crosstab.present_states(rows))
        ),
        "crosstab_empty": on_rows(
            lambda rows: crosstab.crosstab(rows.withColumn("quantity", F.lit(None).cast("long")))
        ),
        "crosstab_margins": on_rows(crosstab.crosstab_margins),
        "pivot_long": on_rows(crosstab.pivot_long),
        "package_outcome": _outcome,
        "client_key": _client_keys,
        "allow_list": _allow_list,
        "report_status": _stock_files,
        "name_clients": _mail_names,
        "report_lines": _report_lines,
        "report_lines_rec": _report_lines_rec,
        "report_lines_rei": _report_lines_rei,
        "overlong_rows": _overlong_rows,
        "read_folder": _read_folder,
        "stray_quotes": _stray_quotes,
        "unparsed_cells": _unparsed_cells,
        "written_report": _written_report,
        "package_status": lambda spark, sf: archives.package_status(fixtures.members(spark, sf)),
        **_llm()[0],
    }
    return {name: _with_folder(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | _llm()[1]
