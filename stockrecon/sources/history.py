"""Reports kept for many runs: tables bucketed by product and slice.

A history is landed once and grows by further landings in the same buckets. Every run
over it, whatever its dates, then joins stock with product sums, and adjustments with
reported products, without moving stock or adjustments: the small side comes in the same
buckets. Adjustments are moved once while they lie in several landings; compacting ends that.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockrecon.domain import keys_of
from stockrecon.operators.sliced import SLICE, layout, layout_text, per_slice, with_slice
from stockrecon.sources.scratch import exists

#: Slices of a crowded product; its sums are stored once per slice.
SLICES = 8
_LAYOUT = "_layout"
_LANDING = "landing string, replaces array<string>, schema string, buckets int, slices int"


def write_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    """Write ``df``, which has slices, as one sorted file per bucket."""
    by = [*keys_of(df, "fnsku"), SLICE]
    table = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    writer.option("path", path).saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")  # the files stay


def _bucketed_scan(
    spark: SparkSession, path: str, schema: StructType, buckets: int, slices: int
) -> DataFrame:
    table = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        # A column of the table, not one renamed on top, so that a union keeps its buckets.
        + (f" COMMENT '{layout_text(slices, buckets)}'" if f.name == SLICE else "")
        for f in schema
    )
    by = ", ".join(f"`{c}`" for c in ("client", "fnsku", SLICE) if c in schema.names)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet"
        f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    opened = spark.table(table)
    opened.schema  # resolved: the frame knows files and buckets by itself
    spark.sql(f"DROP TABLE {table}")
    return opened


def open_bucketed(
    spark: SparkSession, paths: list[str], schema: StructType, buckets: int, slices: int
) -> DataFrame:
    """Tables that ``write_bucketed`` wrote, as one, in any session, with their layout.

    Equal buckets of several tables are read together where nothing before the join
    rules out null keys: stock is not moved. A semi join does so, and Spark 4.1 then shuffles
    the adjustments of several landings once.
    """
    parts = [_bucketed_scan(spark, path, schema, buckets, slices) for path in paths]
    if len(parts) > 1:
        # Spark 4.1 puts buckets together only where rows, not column batches, are united,
        # and groups wrongly otherwise. The filter, which all rows pass, turns batches into
        # rows; it allows for null, as a column that cannot be null ends the match of buckets.
        parts = [part.where(~F.col(SLICE).eqNullSafe("")) for part in parts]
    return reduce(DataFrame.unionAll, parts)


def _land(
    dealt: DataFrame, path: str, buckets: int, slices: int, replaces: list[str]
) -> DataFrame:
    """Write a landing, then the line that makes it part of the history."""
    spark, landing = dealt.sparkSession, uuid.uuid4().hex
    write_bucketed(dealt, f"{path}/rows/{landing}", buckets)
    row = (landing, replaces, dealt.schema.json(), buckets, slices)
    line = spark.createDataFrame([row], _LANDING).coalesce(1)
    line.write.mode("append").json(f"{path}/{_LAYOUT}")
    return open_history(spark, path)


def _landings(spark: SparkSession, path: str) -> list[Row]:
    """One row per landing that counts; those that a later one replaces do not."""
    found = spark.read.schema(_LANDING).json(f"{path}/{_LAYOUT}").collect()
    replaced = {landing for row in found for landing in row["replaces"]}
    return sorted(row for row in found if row["landing"] not in replaced)


def land_history(
    df: DataFrame, path: str, *, buckets: int | None = None, slices: int = SLICES
) -> DataFrame:
    """Keep stock or adjustments under ``path``, where no history is yet, and open them.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``. Choose at least that many,
    and so many that a bucket fits a task when the history has grown: joins on it run
    with one task per bucket.
    """
    spark = df.sparkSession
    if exists(spark, f"{path}/{_LAYOUT}"):
        raise ValueError(f"there is a history in {path}; add_to_history adds to it")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _land(with_slice(df, slices, buckets), path, buckets, slices, [])


def add_to_history(df: DataFrame, path: str) -> DataFrame:
    """Add the rows of ``df`` as a further landing; what is there is not read or written.

    Columns are matched by name and take the types of the history; absent ones are null,
    unknown ones an error. A landing that fails leaves the history as it was. Rows are
    added as they are: what was landed before is not looked for.
    """
    first = _landings(df.sparkSession, path)[0]
    schema = StructType.fromJson(json.loads(first["schema"]))
    wanted = [f for f in schema if f.name != SLICE]
    if unknown := set(df.columns) - {f.name for f in wanted}:
        raise ValueError(f"columns that the history does not have: {sorted(unknown)}")
    shaped = df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )
    dealt = with_slice(shaped, first["slices"], first["buckets"])
    return _land(dealt, path, first["buckets"], first["slices"], [])


def compact_history(spark: SparkSession, path: str) -> DataFrame:
    """Write all landings as one, so that a bucket is one sorted file again and joins of
    any kind leave it in place.

    The old landings' files stay for runs that still read them, under ``rows``.
    """
    old = _landings(spark, path)
    first = old[0]
    replaces = [row["landing"] for row in old]
    return _land(open_history(spark, path), path, first["buckets"], first["slices"], replaces)


def open_history(spark: SparkSession, path: str) -> DataFrame:
    """All landings of a history. Each is listed last, so one that failed is not read."""
    found = _landings(spark, path)
    first = found[0]
    schema = StructType.fromJson(json.loads(first["schema"]))
    paths = [f"{path}/rows/{row['landing']}" for row in found]
    return open_bucketed(spark, paths, schema, first["buckets"], first["slices"])


def put_sums(products: DataFrame, like: DataFrame, path: str) -> DataFrame:
    """Store product sums once per slice of their product in the sliced table ``like``, in
    the buckets of that table."""
    slices, buckets = layout(like)
    dealt = per_slice(products, like)
    write_bucketed(dealt, path, buckets)
    return open_bucketed(products.sparkSession, [path], dealt.schema, buckets, slices)
