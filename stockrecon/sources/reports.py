"""CSV reports: discovery by file name, columns by header name, ragged rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stockrecon.domain import REPORT_KINDS
from stockrecon.functions.text import file_kind_matches
from stockrecon.operators.skew import BROADCAST_ROWS, broadcast_if_small
from stockrecon.schemas import REPORT_SCHEMAS
from stockrecon.sources.packages import exactly_one_each, kinds_found, report_status
from stockrecon.sources.records import (
    block_facts,
    cell_texts,
    cut_records,
    file_lines,
    linked_states,
)
from stockrecon.sources.scratch import store

# --- fixed values: cell texts that stand for "no value" ---------------------
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# ----------------------------------------------------------------------------

ENCODING = "ISO-8859-1"  # decodes any byte, so no second attempt is ever needed
RAW = "raw"
#: Lines as they are, the header line of each file left out. No byte of a report is a separator.
LINE_OPTIONS = {
    "sep": "\u0001", "quote": "", "header": True, "encoding": ENCODING, "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RAW,
}
FRACTIONS = "decimal(38,6)"


def _number(cell: Column) -> Column:
    """Whole number, also when written like ``12.0``."""
    return F.coalesce(
        cell.try_cast("bigint"),
        F.when(cell.rlike(r"^\s*[+-]?\d+\.0*\s*$"), cell.try_cast(FRACTIONS)).try_cast("bigint"),
    )


def with_names(headers: DataFrame) -> DataFrame:
    """Add ``names``, the column names of each ``header`` record, dashes replaced."""
    header = F.replace(F.col("header"), F.lit("-"), F.lit("_"))
    return headers.withColumn("names", cell_texts(header))


def further_names(named: DataFrame, kind: str) -> list[str]:
    """Names in any header beyond those of the kind; one per column of the result."""
    known = REPORT_SCHEMAS[kind].names
    found = named.select(F.explode("names").alias("n")).where(~F.col("n").isin(known)).distinct()
    return sorted(r[0] for r in found.collect())


def with_cells(rows: DataFrame, record: str) -> DataFrame:
    """Replace a record by ``cells``, what its cells say.

    They pass an explode of one element, which the optimizer does not look through: a
    condition on cells would otherwise cut each record once more.
    """
    cells = F.explode(F.array(cell_texts(F.col(record)))).alias("cells")
    return rows.select(*[c for c in rows.columns if c != record], cells)


def _cell(name: str) -> Column:
    """Value of the cell under a name; null where the layout, or the row, lacks it.

    Also null where the cell stands for no value.
    """
    place = F.array_position("names", name)
    cell = F.get("cells", (place - 1).cast("int"))
    return F.when((place > 0) & ~cell.isin(NULL_WORDS), cell)


def _typed(name: str, kind: str, count_columns: tuple[str, ...]) -> Column | None:
    """The number in a cell, or None for a column of text."""
    known = {f.name: f.dataType for f in REPORT_SCHEMAS[kind]}
    if isinstance(known.get(name), LongType):
        return _number(_cell(name))
    return _cell(name).try_cast(FRACTIONS) if name in count_columns else None


def _fits() -> Column:
    return F.size("cells") <= F.size("names")


def shape_rows(
    rows: DataFrame, further: list[str], kind: str, count_columns: tuple[str, ...] = ()
) -> DataFrame:
    """Name and type the ``cells`` of a row (``with_cells``) by the ``names`` of its header.

    Rows longer than their header go, whatever the surplus cells hold; short ones
    end in nulls. Columns a layout lacks are null. Columns beyond the known ones
    (``further``) are text unless listed in ``count_columns``. Each cell is looked
    up by the position of its name, so any number of layouts gives the same plan.
    """
    out = []
    for name in [*REPORT_SCHEMAS[kind].names, *further]:
        if name not in ("client", ""):
            value = _typed(name, kind, count_columns)
            out.append((_cell(name) if value is None else value).alias(name))
    return rows.where(_fits()).select("client", *out)


def report_losses(
    rows: DataFrame, kind: str, count_columns: tuple[str, ...] = ()
) -> DataFrame:
    """What reading loses, per client: ``kind, rows, skipped_rows, unparsed_cells``.

    ``skipped_rows`` are longer than their header. ``unparsed_cells`` stand in number
    columns of the other rows and are neither empty nor a whole number (in
    ``count_columns``: nor a decimal); they are read as null.
    """
    unparsed = F.lit(0)
    for name in [*REPORT_SCHEMAS[kind].names, *count_columns]:
        value = _typed(name, kind, count_columns)
        if value is not None:
            unparsed += (_cell(name).isNotNull() & value.isNull()).cast("int")
    return rows.groupBy("client").agg(
        F.lit(kind).alias("kind"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~_fits()).alias("skipped_rows"),
        F.coalesce(F.sum(F.when(_fits(), unparsed)), F.lit(0)).cast("long").alias("unparsed_cells"),
    )


def client_of(path: Column) -> Column:
    """Name of the folder a file lies in."""
    folder = F.element_at(F.split(path, "/"), -2)
    return F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))


def name_of(path: Column) -> Column:
    return F.url_decode(
        F.replace(F.element_at(F.split(path, "/"), -1), F.lit("+"), F.lit("%2B"))
    )


def _of_kind(file_name: Column, kind: str) -> Column:
    return file_kind_matches(F.replace(file_name, F.lit("%20"), F.lit(" ")), kind)


def _lines(spark: SparkSession, paths, kind: str) -> DataFrame:
    """Lines of every file of a kind; file names are filtered while listing."""
    return file_lines(spark, paths, ENCODING).where(_of_kind(F.col("file_name"), kind))


def file_headers(facts: DataFrame) -> DataFrame:
    """``path, first_line, header, broken`` of files that are not blank, from ``block_facts``.

    ``broken`` files have a line that leaves a quoted cell open. In all others each line
    is a record, and ``header`` is the first that is not blank. It is null where a broken
    file's first record goes on in another block.
    """
    files = facts.groupBy("path").agg(
        *[
            F.max(F.when(F.col("block") == 0, F.col(c))).alias(c)
            for c in ("starts0", "first_line", "header")
        ],
        F.max("broken").alias("broken"),
    )
    return files.where("starts0 > 0").drop("starts0")


def _plain_rows(spark: SparkSession, paths, kind: str) -> DataFrame:
    """``path, record`` of files whose lines are records, without their headers."""
    schema = StructType([StructField(c, StringType()) for c in ("line", RAW)])
    lines = spark.read.schema(schema).options(**LINE_OPTIONS).csv(paths)
    return lines.where(_of_kind(F.col("_metadata.file_name"), kind)).select(
        F.col("_metadata.file_path").alias("path"), F.coalesce(RAW, "line").alias("record")
    )


def _broken_rows(lines: DataFrame, facts: DataFrame, files: DataFrame):
    """Headers, and ``path, record``, of files whose cells hold line breaks.

    ``files`` are their ``file_headers``.
    """
    paths = files.select("path")
    if paths.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # Lines must stay in order, so only a broadcast may choose among them.
        lines = lines.join(F.broadcast(paths), "path", "left_semi")
    states = store(linked_states(facts.join(paths, "path", "left_semi")))
    records = cut_records(lines, states)
    headers = files.where("header is not null").select("path", "header")
    late = files.where("header is null").select("path")
    if late.limit(1).count():
        first = records.where("number = 1").join(late, "path", "left_semi")
        headers = headers.unionByName(first.select("path", F.col("record").alias("header")))
    return headers, records.where("number > 1").select("path", "record")


def _layouts(headers: DataFrame) -> DataFrame:
    """``path, client, names`` of each file, found once and not in every row."""
    client = client_of(F.col("path")).alias("client")
    return with_names(headers).select("path", client, "names")


def raw_rows(
    spark: SparkSession, paths: str | list[str], kind: str, *, columns: list[str] | None = None,
    multi_line: bool = True,
) -> tuple[DataFrame, list[str]] | None:
    """``client, names, cells`` of every row of a kind, and the further names; None without files."""
    if columns is not None and not multi_line:
        names = [c.replace("-", "_") for c in columns]
        rows = _plain_rows(spark, paths, kind).withColumn("names", F.array(*map(F.lit, names)))
        further = sorted(set(names) - set(REPORT_SCHEMAS[kind].names))
        rows = rows.withColumn("client", client_of(F.col("path")))
    else:
        lines = _lines(spark, paths, kind)
        facts = store(block_facts(lines))
        files = store(file_headers(facts))
        plain = files.select("path", F.col("first_line").alias("header"))
        if multi_line:
            plain = files.where("not broken").select("path", "header")
        parts = []
        if plain.limit(1).count():
            parts.append((plain, _plain_rows(spark, paths, kind)))
        if multi_line and files.where("broken").limit(1).count():
            headers, records = _broken_rows(lines, facts, files.where("broken"))
            parts.append((store(headers), records))
        if not parts:
            return None
        named = with_names(reduce(DataFrame.unionByName, [headers for headers, _ in parts]))
        further = further_names(named, kind)
        rows = reduce(
            DataFrame.unionByName,
            [
                records.join(broadcast_if_small(_layouts(headers)), "path")
                for headers, records in parts
            ],
        )
    return with_cells(rows.select("client", "names", "record"), "record"), further


def read_report(
    spark: SparkSession,
    paths: str | list[str],
    kind: str,
    *,
    columns: list[str] | None = None,
    count_columns: tuple[str, ...] = (),
    multi_line: bool = True,
) -> DataFrame:
    """One kind of report from CSV files laid out as ``<client>/<file>``.

    Columns are found by header name, so files may order them differently: one
    more pass over the text finds the header lines, and rows are mapped by the
    layout of their file. The same pass finds the files whose cells hold line
    breaks inside quotes; these are cut by ``records``. Files of either sort are
    split among tasks. A quote opens a quoted cell only at the start of a cell.

    With ``multi_line=False`` every line is taken as a row. If ``columns`` is given
    too, every file has that layout, and the extra pass is left out.
    """
    found = raw_rows(spark, paths, kind, columns=columns, multi_line=multi_line)
    if found is None:
        return spark.createDataFrame([], REPORT_SCHEMAS[kind])
    return shape_rows(*found, kind, count_columns)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Files under ``<root>/<client>/``: client, name, path, arrival. Contents stay unread."""
    files = spark.read.format("binaryFile").load(f"{root}/*/*")
    path = F.col("_metadata.file_path")
    return files.select(
        client_of(path).alias("client"),
        name_of(path).alias("name"),
        "path",
        F.col("modificationTime").alias("arrived"),
    )


LOSSES = "client string, kind string, rows long, skipped_rows long, unparsed_cells long"


def with_losses(status: DataFrame, losses: DataFrame) -> DataFrame:
    """``status`` with ``skipped_rows`` and ``unparsed_cells`` of each client, 0 where unread."""
    counts = ["skipped_rows", "unparsed_cells"]
    total = losses.groupBy("client").agg(*[F.sum(c).alias(c) for c in counts])
    return status.join(total, "client", "left").fillna(0, subset=counts)


def read_packages(
    spark: SparkSession, root: str, *, count_columns: tuple[str, ...] = (), multi_line: bool = True
) -> dict[str, DataFrame]:
    """The three reports of every complete client folder, ``status`` of all, and ``losses``.

    ``losses`` is ``report_losses`` of the complete folders, one row per client and kind;
    ``status`` has their sums. Both read the files when they are asked for.
    """
    files = list_files(spark, root)
    complete = kinds_found(files, ["client"]).where(exactly_one_each()).select("client")
    complete = broadcast_if_small(store(complete))
    reports, losses = {}, [spark.createDataFrame([], LOSSES)]
    for kind in REPORT_KINDS:
        found = raw_rows(spark, f"{root}/*/*", kind, multi_line=multi_line)
        if found is None:
            reports[kind] = spark.createDataFrame([], REPORT_SCHEMAS[kind])
            continue
        rows, further = found
        rows = rows.join(complete, "client", "left_semi")
        reports[kind] = shape_rows(rows, further, kind, count_columns)
        losses.append(report_losses(rows, kind, count_columns))
    losses = reduce(DataFrame.unionByName, losses)
    return {**reports, "status": with_losses(report_status(files), losses), "losses": losses}
