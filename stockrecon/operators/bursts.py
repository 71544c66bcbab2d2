"""Bursts: runs of adjustments whose transaction ids are close together.

Ids at most 10,000 apart belong to one burst. A burst is named after its first
id (``tr_id``); an adjustment that is alone gets 0.

Two forms give the same answer:

* ``assign_bursts_window`` compares every row with its neighbours in id order, by an
  ordered scan over range blocks.
* ``assign_bursts`` first reduces rows to id buckets as wide as the allowed gap.
  Ids in one bucket are always close, so a burst is a run of buckets, and a
  bucket's neighbours can only be the buckets next to it. Runs are linked in
  blocks of a fixed number of buckets, so no task ever orders more than a block
  however many rows one client, one burst or one id has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.domain import MAX_ID_GAP, keys_of
from stockrecon.functions.text import movement_case, rule_keys
from stockrecon.operators.ordered import in_block, range_blocks, with_carried, with_edges
from stockrecon.operators.skew import join_by

ID = "transaction_item_id"

# Buckets per block. Both windows below are bounded by the ids alone, not by the
# rows: a block has at most 2**21 buckets, and 17-digit ids span fewer than five
# million blocks per client.
FANOUT = 1 << 21


def _floor_to(value: Column, width: int) -> Column:
    return value - F.pmod(value, F.lit(width))


def bucket_of(id_column: str = ID, gap: int = MAX_ID_GAP) -> Column:
    """Start of the id bucket; exact on bigint, also for negative ids."""
    return _floor_to(F.col(id_column), gap)


def bucket_summary(adj: DataFrame, gap: int = MAX_ID_GAP) -> DataFrame:
    """One row per occupied bucket: first id, last id and ``facts``.

    ``facts`` packs whether the bucket holds a single row (lowest bit) and the
    last rule key: the id's offset in the bucket with the key's code, -1 if
    there is none. The largest value is the last matching row in id order, ties
    going to the greater case text. All state is numeric, so this is a plain
    hash aggregation that combines before the shuffle, however many rows share
    an id. It is one column so that every later use of the buckets needs the
    same columns and Spark runs the scan and shuffle once.
    """
    part = keys_of(adj)
    code = F.array_position(F.array(*map(F.lit, rule_keys())), movement_case()) - 1
    last_key = F.max(
        F.when(code >= 0, F.pmod(F.col("id"), F.lit(gap)) * len(rule_keys()) + code)
    )
    present = adj.withColumnRenamed(ID, "id")
    for key in part + ["id"]:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*part, bucket_of("id", gap).alias("bucket")).agg(
        F.min("id").alias("lo"),
        F.max("id").alias("hi"),
        (F.coalesce(last_key, F.lit(-1)) * 2 + (F.count("*") == 1).cast("long")).alias("facts"),
    )


def link_buckets(buckets: DataFrame, gap: int = MAX_ID_GAP, fanout: int = FANOUT) -> DataFrame:
    """Give every occupied bucket the first id of its burst (0 for a lone row)."""
    part = keys_of(buckets)
    width = gap * fanout

    # A bucket on the edge of a block is also shown to the block next to it, so
    # that the neighbour test needs no second look across blocks.
    offset = F.pmod(F.col("bucket"), F.lit(width))
    own = _floor_to(F.col("bucket"), width)
    placed = buckets.select(
        "*",
        F.explode(
            F.array_compact(
                F.array(
                    own,
                    F.when(offset == 0, own - width),
                    F.when(offset == width - gap, own + width),
                )
            )
        ).alias("block"),
    )

    in_block = Window.partitionBy(*part, "block").orderBy("bucket")
    real = own == F.col("block")
    gap_before = F.coalesce(F.col("lo") - F.lag("hi").over(in_block) > gap, F.lit(True))
    gap_after = F.coalesce(F.lead("lo").over(in_block) - F.col("hi") > gap, F.lit(True))
    single = F.col("facts") % 2 != 0
    marked = (
        placed.withColumn("lone", single & gap_before & gap_after)
        .withColumn("start", F.when(real & gap_before & ~F.col("lone"), F.col("lo")))
        .withColumn(
            "inside",
            F.max("start").over(in_block.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .where(real)
    )

    # Starts grow with the bucket, so the last start seen is the largest one.
    earlier = Window.partitionBy(*part).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        marked.groupBy(*part, "block")
        .agg(F.max("start").alias("start"))
        .select(*part, "block", F.max("start").over(earlier).alias("carry"))
    )
    return marked.join(blocks, part + ["block"], "left").select(
        *part,
        "bucket",
        F.shiftright("facts", 1).alias("last_key"),
        F.when(F.col("lone"), F.lit(0).cast("long"))
        .otherwise(F.coalesce("inside", "carry"))
        .alias("tr_id"),
    )


def burst_buckets(adj: DataFrame, gap: int = MAX_ID_GAP, fanout: int = FANOUT) -> DataFrame:
    """Occupied buckets that belong to a burst, with ``tr_id`` and ``last_key``."""
    return link_buckets(bucket_summary(adj, gap), gap, fanout).where(F.col("tr_id") != 0)


def attach_bursts(adj: DataFrame, buckets: DataFrame, gap: int = MAX_ID_GAP) -> DataFrame:
    """Adjustments with ``tr_id`` from ``burst_buckets``.

    Both sides reach the join straight from their shuffle, so adaptive execution
    can split a bucket that holds a large share of the rows.
    """
    part = keys_of(adj)
    placed = adj.withColumn("bucket", bucket_of(gap=gap))
    bursts = buckets.select(*part, "bucket", "tr_id")
    return (
        join_by(placed, bursts, part + ["bucket"], "left")
        .withColumn("tr_id", F.coalesce("tr_id", F.lit(0).cast("long")))
        .select(*adj.columns, "tr_id")
    )


def assign_bursts(adj: DataFrame, gap: int = MAX_ID_GAP, fanout: int = FANOUT) -> DataFrame:
    """Add ``tr_id`` to every adjustment (bucket form). Clip dates first."""
    return attach_bursts(adj, burst_buckets(adj, gap, fanout), gap)


def assign_bursts_window(
    adj: DataFrame, gap: int = MAX_ID_GAP, blocks: int | None = None
) -> DataFrame:
    """Add ``tr_id`` to every adjustment by an ordered scan over range blocks.

    Neighbours and the burst that is open at the start of a block come from the
    blocks' edges; rows are stored once.
    """
    part = keys_of(adj)
    # Equal ids are told apart by a mixed number, so that a crowded id is cut too.
    dealt = adj.withColumn("_turn", F.xxhash64(F.monotonically_increasing_id()))
    rows = with_edges(range_blocks(dealt, part, [ID, "_turn"], blocks=blocks), part, ID)
    order = in_block(part, [ID])
    back = F.col(ID) - F.coalesce(F.lag(ID).over(order), "edge_before")
    ahead = F.coalesce(F.lead(ID).over(order), "edge_after") - F.col(ID)
    joins = F.coalesce(back <= gap, F.lit(False))
    opens = F.coalesce(ahead <= gap, F.lit(False))
    first = F.when(joins, None).otherwise(F.when(opens, F.col(ID)).otherwise(F.lit(0)))
    started = rows.withColumn("first_id", first)
    return with_carried(started, part, "first_id", [ID], "tr_id").select(*adj.columns, "tr_id")


def burst_totals(adj: DataFrame, gap: int = MAX_ID_GAP, fanout: int = FANOUT) -> DataFrame:
    """One row per burst: ``tr_id, last_id, adjustments, quantity``.

    Buckets are summed before the shuffle and bursts are summed over their buckets, so
    no task holds the rows of a burst or of a client.
    """
    part = keys_of(adj)
    present = adj.dropna(subset=[*part, ID])
    sums = present.groupBy(*part, bucket_of(gap=gap).alias("bucket")).agg(
        F.max(ID).alias("last_id"), F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")
    )
    return (
        sums.join(burst_buckets(adj, gap, fanout), [*part, "bucket"])
        .groupBy(*part, "tr_id")
        .agg(
            F.max("last_id").alias("last_id"),
            F.sum("n").alias("adjustments"),
            F.coalesce(F.sum("q"), F.lit(0)).cast("long").alias("quantity"),
        )
    )
