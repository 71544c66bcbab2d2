"""Packages: which files a client handed in, from whom, and whether they are complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.domain import REPORT_KINDS
from stockrecon.functions.text import client_key, file_kind_matches, repeat_suffix
from stockrecon.operators.ordered import BLOCK, range_blocks, with_number
from stockrecon.sources.scratch import store


def kinds_found(files: DataFrame, by: list[str]) -> DataFrame:
    """Per package, how many files announce each kind."""
    return files.groupBy(*by).agg(
        *[
            F.count_if(file_kind_matches(F.col("name"), k)).alias(f"{k}_files")
            for k in REPORT_KINDS
        ]
    )


def exactly_one_each() -> Column:
    """Whether a row of ``kinds_found`` has one file of every kind."""
    one, *others = [F.col(f"{k}_files") == 1 for k in REPORT_KINDS]
    for other in others:
        one = one & other
    return one


def report_status(files: DataFrame) -> DataFrame:
    """Per client: files of each kind and what is wrong with them, if anything."""
    problem = F.lit("ok")
    for kind in reversed(REPORT_KINDS):
        n = F.col(f"{kind}_files")
        problem = (
            F.when(n == 0, f"no file for {kind}")
            .when(n > 1, f"several files for {kind}")
            .otherwise(problem)
        )
    return kinds_found(files, ["client"]).withColumn("status", problem)


def allowed_only(packages: DataFrame, senders: DataFrame) -> DataFrame:
    """Packages whose ``sender`` is on the list; list entries are trimmed.

    No forced broadcast: adaptive execution decides by the list's real size.
    """
    allowed = senders.select(F.trim("sender").alias("sender")).distinct()
    return packages.join(allowed, "sender", "left_semi")


def name_clients(
    packages: DataFrame,
    seen: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] = store,
) -> DataFrame:
    """Add ``client`` from ``subject``; a repeated name gets its arrival time appended.

    ``packages`` needs ``subject``, ``arrived`` and a unique ``package``; ``seen``
    lists ``client`` names already in use. The first arrival of a new name keeps
    it plain. Packages of one name in one second are numbered, by block counts.
    First arrivals and later packages are stored by ``keep``; both sides of the join
    come straight from their shuffle and Spark splits a frequent name.
    """
    keyed = packages.withColumn("key", client_key(F.col("subject")))
    first = keyed.groupBy("key").agg(
        F.min(F.struct("arrived", "package")).alias("first")
    )
    if seen is None:
        first = first.withColumn("known", F.lit(False))
    else:
        used = seen.select(F.col("client").alias("key")).distinct().withColumn("known", F.lit(True))
        first = first.join(used, "key", "left").fillna(False, subset=["known"])
    keyed = keyed.join(keep(first), "key")
    plain = ~F.col("known") & (F.col("package") == F.col("first.package"))
    named = keyed.withColumn("again", F.when(~plain, repeat_suffix(F.col("arrived"))))
    # One second of one name may hold any number of packages.
    columns = ["key", "again"]
    rest = range_blocks(named.where("again is not null"), columns, ["arrived", "package"], keep)
    counted = with_number(rest, columns, ["arrived", "package"], "number").drop(BLOCK)
    named = named.where("again is null").withColumn("number", F.lit(1).cast("long")).unionByName(counted)
    clash = F.when(F.col("number") > 1, F.concat(F.lit("_"), "number"))
    return named.withColumn(
        "client",
        F.concat("key", F.coalesce("again", F.lit("")), F.coalesce(clash, F.lit(""))),
    ).select(*packages.columns, "client")
