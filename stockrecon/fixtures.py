"""Public benchmark tables read as the three reports, for tests and timing.

Pure arithmetic over `lineitem` and `part`, so any SQL engine can repeat it.
The value maps are invented.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.domain import DISPOSITIONS
from stockrecon.sources.archives import BROKEN, NOT_ZIP
from stockrecon.sources.shipping import ship_package

AS_OF = "2001-11-04"
# The last one has stock but no movements; the one before, movements but no bursts.
CLIENTS = ["C0", "C1", "C2", "C3", "C4", "C5"]
SCATTERED, IDLE = CLIENTS[-2:]
REASON_CYCLE = [
    "P", "Q", "E", "5", "M", "F", "N", "O", "D", "G", "I", "K", "1", "2", "D", "P", "Q",
    "Damaged_by_FC", "Disposed_of", "Misplaced",
]


def _pick(values: list[str], position: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), position.cast("int"))


def _client() -> Column:
    return F.concat(F.lit("C"), F.expr("(l_orderkey div 4) % 5").cast("string"))


def _fnsku(key: str) -> Column:
    return F.concat(F.lit("X"), F.col(key).cast("string"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a movement; some lack product, state or quantity."""
    line = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("long")
    near = F.col("l_orderkey") * 5000 + line * 500
    far = (F.col("l_orderkey") * 10 + line) * 10**10 + F.col("l_partkey") * 20_000
    state = _pick(DISPOSITIONS, (F.col("l_orderkey") + line * 5 + F.col("l_suppkey")) % 8)
    return table(spark, sf_dir, "lineitem").select(
        _client().alias("client"),
        F.when(_client() == SCATTERED, far).otherwise(near).alias("transaction_item_id"),
        F.col("l_shipdate").alias("adjusted_date"),
        F.when(~((F.col("l_orderkey") % 41 == 0) & (line == 6)), _fnsku("l_partkey")).alias(
            "fnsku"
        ),
        F.concat(F.lit("FC"), (F.col("l_suppkey") % 20).cast("string")).alias(
            "fulfillment_center_id"
        ),
        _pick(REASON_CYCLE, (F.col("l_partkey") + line * 3 + F.col("l_suppkey")) % 20).alias(
            "reason"
        ),
        F.when((F.col("l_orderkey") + line) % 37 != 0, state).alias("disposition"),
        F.when((F.col("l_partkey") + line) % 43 == 0, None)
        .when((F.col("l_partkey") + line) % 3 == 0, quantity)
        .otherwise(-quantity)
        .alias("quantity"),
    )


def reimbursements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a reimbursement; some products are in no stock report."""
    quantity = F.col("l_quantity").cast("long")
    unknown = F.concat(F.lit("Y"), F.col("l_partkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        _client().alias("client"),
        F.col("l_shipdate").alias("approval_date"),
        F.when(F.col("l_linenumber") == 7, unknown).otherwise(_fnsku("l_partkey")).alias("fnsku"),
        F.when(F.col("l_returnflag") == "R", "Lost_Warehouse")
        .when(F.col("l_returnflag") == "A", "Damaged_Warehouse")
        .otherwise("CustomerReturn")
        .alias("reason"),
        quantity.alias("quantity_reimbursed_total"),
        F.when(F.col("l_linenumber") % 3 == 0, quantity)
        .otherwise(F.lit(0).cast("long"))
        .alias("quantity_reimbursed_inventory"),
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part for every client, with a further count and a further text."""
    key = F.col("p_partkey").cast("string")
    busy = F.col("client") != IDLE

    def count(value: Column) -> Column:
        return F.when(busy, value).otherwise(0).cast("long")

    # Few files hold very many parts: they are dealt to all cores before they multiply.
    parts = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism)
    return (
        parts
        .withColumn("client", F.explode(F.array(*map(F.lit, CLIENTS))))
        .select(
            "client",
            F.concat(F.lit("S"), key).alias("sku"),
            F.concat(F.lit("X"), key).alias("fnsku"),
            F.concat(F.lit("B"), key).alias("asin"),
            F.when(F.col("p_size") % 13 != 0, F.col("p_name")).alias("product_name"),
            F.lit("NEW").alias("condition"),
            count(F.col("p_size") - 25).alias("discrepant_quantity"),
            count(F.col("p_size") % 5).alias("quantity"),
            count(F.when(F.col("p_size") == 25, F.col("p_partkey") % 2).otherwise(0)).alias(
                "Ending_count"
            ),
            F.col("p_type").alias("store_note"),
        )
    )


def csv_cell(value: Column, quoted: bool) -> Column:
    """A value as CSV text; null as an empty cell."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    if not quoted:
        return text
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_lines(
    df: DataFrame, name: str, turned: Column, extra: Column | None = None
) -> DataFrame:
    """Rows of a report as records of CSV files, as archives give them.

    Where ``turned`` holds, columns come in reverse and quoted; ``extra`` is text
    behind a row.
    """
    columns = [c for c in df.columns if c != "client"]
    plain = F.concat_ws(",", *[csv_cell(F.col(c), False) for c in columns])
    other = F.concat_ws(",", *[csv_cell(F.col(c), True) for c in reversed(columns)])
    heads = [",".join(c.replace("_", "-") for c in cs) for cs in (columns, reversed(columns))]
    return df.select(
        "client",
        F.lit("a.zip").alias("archive"),
        F.lit(name).alias("name"),
        F.when(turned, heads[1]).otherwise(heads[0]).alias("header"),
        F.concat(F.when(turned, other).otherwise(plain), F.lit("") if extra is None else extra)
        .alias("line"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files of archives, three to an archive, good and bad ones in turn."""
    pack = F.expr("p_partkey div 3")
    kind = _pick(["rec", "adj", "rei"], F.col("p_partkey") % 3)
    turn = pack % 6
    problem = F.when(turn == 1, NOT_ZIP).when(turn == 2, BROKEN)
    name = F.when(turn == 4, "x_rec.csv").otherwise(F.concat(F.lit("x_"), kind, F.lit(".csv")))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("C"), pack.cast("string")).alias("client"),
        F.concat(F.lit("p"), pack.cast("string"), F.lit(".zip")).alias("archive"),
        problem.alias("problem"),
        F.when(problem.isNull(), name).alias("name"),
        ((turn == 3) & (F.col("p_partkey") % 3 == 0)).alias("in_folder"),
    )


def _as_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lines of each client and name, many to a row; the first row has the header."""
    seen = set()
    for place, batch in enumerate(batches):
        texts = {}
        columns = [
            batch.column(c).to_numpy(zero_copy_only=False).tolist()
            for c in ("client", "name", "header", "line")
        ]
        for client, name, header, line in zip(*columns):
            file = client, name
            if file not in texts:
                texts[file] = [] if file in seen else [header]
                seen.add(file)
            texts[file].append(line)
        rows = [(*file, place, "\n".join(lines)) for file, lines in texts.items()]
        types = [pa.string(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["client", "name", "place", "line"]
        )


def drop_files(lines: DataFrame, folder: str) -> str:
    """Write ``client, name, header, line`` as CSV files ``<folder>/<client>/<n>_<name>``.

    Each task writes its own file of a client, with the header; no row changes its task.
    Returns a pattern that finds them all.
    """
    spark = lines.sparkSession
    ship_package(spark)
    by = ["client", "name"]
    text = lines.select(*by, "header", "line").mapInArrow(
        _as_files, "client string, name string, place long, line string"
    )
    (
        text.sortWithinPartitions(*by, "place").select(*by, "line")
        .write.partitionBy(*by).text(f"{folder}/written")
    )
    # Only names change: one call for each file.
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in system.globStatus(path(f"{folder}/written/*/*/part-*")):
        source = file.getPath()
        part = source.getName().split("-")[1]
        values, at = [], source.getParent()
        for _ in by:
            values.append(at.getName().partition("=")[2])
            at = at.getParent()
        name, client = values
        system.mkdirs(path(f"{folder}/landing/{client}"))
        system.rename(source, path(f"{folder}/landing/{client}/{part}_{name}"))
    return f"{folder}/landing"


def odd_note(place: Column) -> tuple[Column, Column]:
    """A note as written in a CSV file and as read: inch marks, quotes, line breaks."""
    kinds = [
        ('5" pipe', '5" pipe'), ('"a, ""b""\nc"', 'a, "b"\nc'), ('say ""twice""', 'say ""twice""'),
        ('end 6"', 'end 6"'), ('"closed" then "open', 'closed then "open'),
    ]
    return tuple(_pick([k[i] for k in kinds], place % len(kinds)) for i in (0, 1))


def with_odd_notes(rows: DataFrame) -> DataFrame:
    """Adjustments as CSV lines with an odd note at the start and at the end of each."""
    place = F.expr("transaction_item_id div 500")
    columns = [c for c in rows.columns if c != "client"]
    cells = [odd_note(place)[0], *[csv_cell(F.col(c), False) for c in columns], odd_note(place + 1)[0]]
    names = ["first-note", *[c.replace("_", "-") for c in columns], "last-note"]
    return rows.select(
        "client", F.lit("x_adj.csv").alias("name"), F.lit(",".join(names)).alias("header"),
        F.concat_ws(",", *cells).alias("line"),
    )


def with_unparsed_cells(rows: DataFrame) -> DataFrame:
    """Adjustments as CSV lines whose quantity is, in turn, a number, none, or too much."""
    turn = F.expr("transaction_item_id div 500 % 7")
    columns = [c for c in rows.columns if c not in ("client", "quantity")]
    quantity = (
        F.when(turn == 1, "12.5").when(turn == 2, "abc").when(turn == 3, '"1,5"').when(turn == 4, "7.0")
        .when(turn == 5, "1,2").otherwise(csv_cell(F.col("quantity"), False))
    )
    names = [*[c.replace("_", "-") for c in columns], "quantity"]
    return rows.select(
        "client", F.lit("x_adj.csv").alias("name"), F.lit(",".join(names)).alias("header"),
        F.concat_ws(",", *[csv_cell(F.col(c), False) for c in columns], quantity).alias("line"),
    )
