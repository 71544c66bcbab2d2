"""Results as tables, one folder per client."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.domain import keys_of
from stockrecon.operators.bursts import burst_buckets
from stockrecon.operators.clip import clip_adjustments, clip_reimbursements
from stockrecon.operators.crosstab import crosstab, order_crosstab, pivot_long
from stockrecon.operators.measures import order_report
from stockrecon.operators.skew import broadcast_if_small
from stockrecon.plans.reconcile import (
    build_report,
    drill_down,
    package_outcome,
    with_bursts_only,
)
from stockrecon.sources.scratch import Shelf, delete, exists

RUNS = "_runs"
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
MANIFEST = "run string, attempt string, tables string, at long"


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write ``df`` under ``<path>/client=<client>/``, replacing ``path``.

    A frame without ``client`` is one client's and lies in ``path`` itself.
    """
    writer = df.write.mode("overwrite").partitionBy(*keys_of(df))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _balanced(df: DataFrame) -> DataFrame:
    """Files of even size per client, however unequal the clients are."""
    return df.hint("rebalance", *keys_of(df))


def _once(report: DataFrame) -> DataFrame:
    """The report behind a shuffle: an ordering reads its input twice, once for a sample."""
    return report.hint("rebalance", F.col("`00_fnsku`"))


class Run:
    """One run's tables below ``out``; nobody sees them before ``commit``.

    A table lies under ``<out>/<table>/run=<run>/try=<try>``, every attempt in a folder of
    its own. The manifest, one small file written last, names the attempt that counts.
    A run that was repeated has the attempt committed last; earlier ones are deleted
    after that.
    """

    def __init__(self, spark: SparkSession, out: str, run: str | int):
        self.spark, self.out, self.run = spark, out, str(run)
        self.attempt = f"t{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def write(self, df: DataFrame, table: str, by_client: bool = True) -> DataFrame:
        """Write a table of the run and read it back."""
        path = f"{self.out}/{table}/run={self.run}/try={self.attempt}"
        self.tables.append(table)
        if by_client:
            write_report(df, path)
        else:
            df.write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        return stored.selectExpr(*[f"`{c}`" for c in df.columns])

    def commit(self) -> None:
        """Make the run visible, all tables at once."""
        before = attempts(self.spark, self.out, self.run)
        row = (self.run, self.attempt, ",".join(self.tables), time.time_ns())
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.json(
            f"{self.out}/{RUNS}/{self.attempt}"
        )
        for attempt, tables in before:
            delete(self.spark, f"{self.out}/{RUNS}/{attempt}")
            for table in tables:
                delete(self.spark, f"{self.out}/{table}/run={self.run}/try={attempt}")

    def discard(self) -> None:
        """Delete what a failed attempt has written."""
        for table in self.tables:
            delete(self.spark, f"{self.out}/{table}/run={self.run}/try={self.attempt}")


def _manifests(spark: SparkSession, out: str) -> DataFrame | None:
    """Committed runs, ``run, attempt, tables``: of each the attempt committed last."""
    if not exists(spark, f"{out}/{RUNS}"):
        return None
    rows = spark.read.schema(MANIFEST).json(f"{out}/{RUNS}/*")
    return rows.groupBy("run").agg(
        F.max_by("attempt", "at").alias("attempt"), F.max_by("tables", "at").alias("tables")
    )


def attempts(spark: SparkSession, out: str, run: str | int) -> list[tuple[str, list[str]]]:
    """Attempts of one run that have a manifest, with their tables."""
    if not exists(spark, f"{out}/{RUNS}"):
        return []
    rows = spark.read.schema(MANIFEST).json(f"{out}/{RUNS}/*").where(F.col("run") == str(run))
    return [(r["attempt"], r["tables"].split(",")) for r in rows.collect()]


def is_committed(spark: SparkSession, out: str, run: str | int) -> bool:
    return bool(attempts(spark, out, run))


def read_results(spark: SparkSession, out: str, table: str) -> DataFrame | None:
    """A table of all committed runs, with ``run``; None if no run has it.

    Runs that failed, or are being written, are not part of it. The manifest is
    one row per run, and Spark reads only the folders it names.
    """
    runs = _manifests(spark, out)
    if runs is None:
        return None
    runs = runs.where(F.array_contains(F.split("tables", ","), table)).select(
        F.col("run").alias("_run"), F.col("attempt").alias("try")
    )
    if not runs.limit(1).count():
        return None
    rows = _as_text(spark, f"{out}/{table}", "*/*")
    columns = [f"`{c}`" for c in rows.columns if c not in ("run", "try")]
    return rows.drop("run").join(broadcast_if_small(runs), "try").selectExpr(*columns, "_run AS run")


def _as_text(spark: SparkSession, base: str, below: str) -> DataFrame:
    """A partitioned table whose folder names stay text, also where they look like numbers."""
    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        return spark.read.option("basePath", base).parquet(f"{base}/{below}")
    finally:
        spark.conf.set(_INFERENCE, before)


def write_results(
    rec: DataFrame,
    adj: DataFrame,
    rei: DataFrame,
    as_of: dt.date | str,
    out: str,
    *,
    run: str | int = 0,
    opening: dt.date | str | None = None,
    gate_on_bursts: bool = False,
    further: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Reconcile and write everything as one run; returns the tables as written.

    The burst buckets are stored once and each later result starts from a
    written earlier one, so nothing is computed twice. ``further`` tables are
    committed with the run. Readers see all tables of a run or none
    (``read_results``); repeating a run replaces its own output only.
    """
    spark = adj.sparkSession
    this = Run(spark, out, run)
    try:
        with Shelf(spark) as shelf:
            written = _write_tables(this, shelf, rec, adj, rei, as_of, opening, gate_on_bursts)
        for name, df in (further or {}).items():
            written[name] = this.write(df, name, by_client=False)
        this.commit()
    except BaseException:
        this.discard()
        raise
    return written


def _write_tables(this, shelf, rec, adj, rei, as_of, opening, gate_on_bursts):
    adj = clip_adjustments(adj, as_of, opening)
    rei = clip_reimbursements(rei, as_of, opening)
    buckets = shelf.put(burst_buckets(adj))
    report = build_report(rec, adj, rei, buckets, shelf.put, shelf)
    if gate_on_bursts:
        report = with_bursts_only(report, buckets)
    report = this.write(order_report(_once(report)), "report")
    rows = this.write(_balanced(drill_down(adj, report, buckets, prefilter=True)), "adjustments")
    table = this.write(order_crosstab(crosstab(rows)), "crosstab")
    long = this.write(_balanced(pivot_long(rows)), "pivot")
    clients = None
    if keys_of(rec):
        clients = reduce(DataFrame.unionByName, [df.select("client") for df in (rec, adj, rei)])
    results = {"df_rec": report, "table": table, "df_adj_filtered": rows}
    outcome = this.write(package_outcome(clients, results), "outcome", by_client=False)
    return {**results, "pivot": long, "outcome": outcome}
