"""Zipped packages: contents as rows, and the verdict on each package."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.domain import REPORT_KINDS
from stockrecon.functions.text import file_kind_matches
from stockrecon.schemas import REPORT_SCHEMAS
from stockrecon.sources.packages import exactly_one_each, kinds_found
from stockrecon.sources.records import records_of
from stockrecon.sources.reports import (
    ENCODING,
    LOSSES,
    report_losses,
    shape_rows,
    with_cells,
    with_names,
)
from stockrecon.sources.shipping import ship_package

# --- fixed values -----------------------------------------------------------
NOT_ZIP = "not ZIP file attached"
BROKEN = "brocken *.zip"
NOT_THREE = "not three files in ZIP"
OK = "ok"
MAC_FOLDER = "__MACOSX"
# ----------------------------------------------------------------------------

LINES_PER_BATCH = 20_000
MEMBERS = "client string, archive string, problem string, name string, in_folder boolean"
CONTENTS = f"{MEMBERS}, header string, line string"


def _files(archive: zipfile.ZipFile) -> dict[str, zipfile.ZipInfo]:
    return {
        i.filename: i
        for i in archive.infolist()
        if not i.is_dir() and MAC_FOLDER not in i.filename.split("/")[:-1]
    }


def _open_package(content: bytes):
    """Files of a package as ``{path: (zip, entry)}``, or a problem text.

    Zips lying at the top of the zip are opened once; a folder that holds
    everything is left out of the paths.
    """
    if not zipfile.is_zipfile(io.BytesIO(content)):
        return None, NOT_ZIP
    try:
        outer = zipfile.ZipFile(io.BytesIO(content))
        if outer.testzip():
            return None, BROKEN
        found = {}
        for path, entry in _files(outer).items():
            inner = None
            if "/" not in path:
                with outer.open(entry) as stream:
                    if zipfile.is_zipfile(stream):
                        inner = zipfile.ZipFile(io.BytesIO(outer.read(entry)))
            if inner is None:
                found[path] = (outer, entry)
            else:
                if inner.testzip():
                    return None, BROKEN
                found.update({p: (inner, e) for p, e in _files(inner).items()})
    except (zipfile.BadZipFile, RuntimeError, NotImplementedError, OSError, EOFError):
        return None, BROKEN
    tops = {p.split("/", 1)[0] if "/" in p else None for p in found}
    if len(tops) == 1 and None not in tops:
        found = {p.split("/", 1)[1]: v for p, v in found.items()}
    return found, None


def archive_contents(archives: DataFrame) -> DataFrame:
    """Files and CSV records of every archive, each archive opened once.

    ``archives`` has ``client``, ``archive`` (file name) and ``content``. A file gives
    a row without ``line``, then one for each record after its ``header``; an archive
    that cannot be used gives one row with its ``problem``. Members are streamed
    record by record; only the archive itself is held in memory.
    """
    ship_package(archives.sparkSession)
    columns = [field.split()[0] for field in CONTENTS.split(", ")]

    def reading(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for client, archive, content in frame.itertuples(index=False):
                found, problem = _open_package(content)
                files = [(client, archive, problem, p, p is not None and "/" in p, None, None)
                         for p in found or [None]]
                yield pd.DataFrame(files, columns=columns)
                for path, (source, entry) in (found or {}).items():
                    with source.open(entry) as stream:
                        lines = io.TextIOWrapper(stream, encoding=ENCODING, newline="")
                        records = records_of(lines)
                        header = next(records, "")
                        while batch := [x for _, x in zip(range(LINES_PER_BATCH), records)]:
                            row = (client, archive, None, path, "/" in path, header)
                            yield pd.DataFrame([(*row, x) for x in batch], columns=columns)

    return archives.select("client", "archive", "content").mapInPandas(reading, CONTENTS)


def members_of(contents: DataFrame) -> DataFrame:
    """One row per file of every archive, or one with the ``problem``."""
    return contents.where("line is null").select(*[f.split()[0] for f in MEMBERS.split(", ")])


def lines_of(contents: DataFrame) -> DataFrame:
    """CSV records of every file of every readable archive, with the file's header record."""
    return contents.where("line is not null").select("client", "archive", "name", "header", "line")


def archive_members(archives: DataFrame) -> DataFrame:
    return members_of(archive_contents(archives))


def package_status(members: DataFrame) -> DataFrame:
    """Verdict per package: ok, or why it cannot be used."""
    # A leading separator lets a bare `rec.csv` announce its kind.
    named = members.withColumn("name", F.concat(F.lit("_"), "name"))
    by = ["client", "archive"]
    facts = named.groupBy(*by).agg(
        F.max("problem").alias("problem"),
        F.count("name").alias("files"),
        F.bool_or("in_folder").alias("folders"),
    )
    kinds = kinds_found(named, by)
    usable = exactly_one_each() & (F.col("files") == 3) & ~F.col("folders")
    return facts.join(kinds, by).select(
        *by,
        F.when(F.col("problem") == BROKEN, F.concat("archive", F.lit(f" - {BROKEN}")))
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(usable, OK)
        .otherwise(NOT_THREE)
        .alias("status"),
    )


def archive_lines(archives: DataFrame) -> DataFrame:
    return lines_of(archive_contents(archives))


def _kinds(lines: DataFrame) -> DataFrame:
    """``lines`` with a flag per kind, whether the file's name announces it."""
    name = F.concat(F.lit("_"), "name")
    return lines.withColumns({f"is_{k}": file_kind_matches(name, k) for k in REPORT_KINDS})


def _raw_rows(lines: DataFrame, kind: str) -> DataFrame:
    named = with_names(_kinds(lines).where(f"is_{kind}"))
    return with_cells(named.select("client", "names", "line"), "line")


def _further_names(lines: DataFrame) -> dict[str, list[str]]:
    """``further_names`` of each kind, in one pass over the headers."""
    flags = [f"is_{k}" for k in REPORT_KINDS]
    headers = with_names(_kinds(lines).select("header", *flags).distinct())
    found = headers.select(F.explode("names").alias("name"), *flags).distinct().collect()
    return {
        kind: sorted(
            {r["name"] for r in found if r[f"is_{kind}"]} - set(REPORT_SCHEMAS[kind].names)
        )
        for kind in REPORT_KINDS
    }


def reports_from_lines(
    lines: DataFrame, count_columns: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """The three reports from ``archive_lines`` of usable packages.

    Reads ``lines`` once per report and once for the header lines, so store it first.
    """
    further = _further_names(lines)
    return {
        kind: shape_rows(_raw_rows(lines, kind), further[kind], kind, count_columns)
        for kind in REPORT_KINDS
    }


def losses_from_lines(lines: DataFrame, count_columns: tuple[str, ...] = ()) -> DataFrame:
    """``report_losses`` of ``archive_lines``, one row per client and kind."""
    losses = lines.sparkSession.createDataFrame([], LOSSES)
    for kind in REPORT_KINDS:
        losses = losses.unionByName(report_losses(_raw_rows(lines, kind), kind, count_columns))
    return losses
