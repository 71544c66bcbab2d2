"""Packages as they arrive: each file is taken once, each package reconciled whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockrecon.operators.skew import broadcast_if_small
from stockrecon.sources.archives import (
    OK,
    archive_contents,
    lines_of,
    losses_from_lines,
    members_of,
    package_status,
    reports_from_lines,
)
from stockrecon.sources.packages import name_clients
from stockrecon.sources.reports import client_of, name_of, with_losses
from stockrecon.sources.scratch import Shelf, delete, exists, move
from stockrecon.sources.sinks import is_committed, read_results, write_results

POLL = "2 hours"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _today() -> dt.date:
    return dt.date.today()


def arrivals(
    spark: SparkSession, landing: str, *, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of archives dropped as ``<landing>/<subject>/<file>``."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(f"{landing}/*/*")
    return files.select(
        "path",
        client_of(F.col("_metadata.file_path")).alias("subject"),
        name_of(F.col("_metadata.file_path")).alias("archive"),
        F.col("modificationTime").alias("arrived"),
        "content",
    )


def reconcile_batch(
    batch: DataFrame,
    out: str,
    run: str,
    as_of: dt.date | str,
    *,
    gate_on_bursts: bool = False,
) -> dict[str, DataFrame]:
    """Name, judge and reconcile the packages of one batch; returns what was written.

    The verdicts (``status``, with what reading lost) and the files taken (``taken``) are
    tables of the run and become visible with it. Intermediate tables are deleted at
    the end, also of a batch that fails.
    """
    spark = batch.sparkSession
    with Shelf(spark) as shelf:
        batch = shelf.put(batch)  # archives are read from the landing folder once
        names = shelf.put(
            name_clients(
                batch.select("subject", "arrived", F.col("path").alias("package")),
                known_clients(spark, out, run),
                keep=shelf.put,
            )
        )
        named = broadcast_if_small(names.select(F.col("package").alias("path"), "client"))
        contents = shelf.put(archive_contents(batch.join(named, "path")))
        status = shelf.put(package_status(members_of(contents)))
        usable = broadcast_if_small(status.where(F.col("status") == OK).select("client"))
        lines = lines_of(contents).join(usable, "client", "left_semi")
        status = with_losses(status, losses_from_lines(lines))
        reports = reports_from_lines(lines)
        return write_results(
            reports["rec"], reports["adj"], reports["rei"], as_of, out,
            run=run, gate_on_bursts=gate_on_bursts,
            further={"status": status, "taken": batch.select("path")},
        )


def known_clients(spark: SparkSession, out: str, run: str) -> DataFrame | None:
    """Clients named by all other committed runs, or nothing before the first."""
    status = read_results(spark, out, "status")
    return None if status is None else status.where(F.col("run") != run).select("client")


def clear_taken(spark: SparkSession, out: str, run: str, archive_to: str | None) -> None:
    """Move the files of a committed run to ``archive_to``, or delete them.

    Files that are gone already are passed over, so this may be repeated.
    """
    taken = read_results(spark, out, "taken")
    if taken is None:
        return
    for row in taken.where(F.col("run") == run).select("path").toLocalIterator():
        if archive_to:
            move(spark, row["path"], archive_to)
        else:
            delete(spark, row["path"])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint; it outlives restarts."""
    text = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id"))
    return text.collect()[0][0]


def stream_packages(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    *,
    as_of: dt.date | str | Callable[[], dt.date] = _today,
    once: bool = False,
    every: str = POLL,
    files_per_batch: int | None = None,
    archive_to: str | None = None,
    remove_taken: bool = False,
    gate_on_bursts: bool = False,
) -> StreamingQuery:
    """Start the pickup: with ``once`` take what is there and stop, else poll.

    The checkpoint remembers which files were taken. A run is named by the query
    and the batch: a batch that is repeated after a failure writes the same run
    again, unless it was committed before, and another checkpoint on the same
    ``out`` writes runs of its own. With ``archive_to`` the files of a batch move there,
    with ``remove_taken`` they are deleted, in either case right after the run's commit
    and never before; what a failure leaves of that is done with the next batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        day = as_of() if callable(as_of) else as_of
        name = stream_id(spark, checkpoint)
        run = f"{name}-{batch_id}"
        if not is_committed(spark, out, run):
            reconcile_batch(batch, out, run, day, gate_on_bursts=gate_on_bursts)
        if archive_to or remove_taken:
            for done in (f"{name}-{batch_id - 1}", run):
                clear_taken(spark, out, done, archive_to)

    trigger = {"availableNow": True} if once else {"processingTime": every}
    source = arrivals(spark, landing, files_per_batch=files_per_batch)
    return (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
