"""Damaged stock re-graded to a good state inside one burst.

In every burst the last bad-state movement in id order sets the rule: movements
of the opposite direction into a good state are suspicious and carry that rule
in ``case1``. Earlier rules of the same burst are void.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.domain import GOOD_STATES, MAX_ID_GAP, OPPOSITE_REASON, keys_of
from stockrecon.functions.text import movement_case, rule_keys
from stockrecon.operators.bursts import FANOUT, bucket_of, burst_buckets
from stockrecon.operators.skew import join_by


def burst_rules(buckets: DataFrame, gap: int = MAX_ID_GAP) -> DataFrame:
    """Per burst: bucket of its first id, ``tr_id`` and the code of its last rule key."""
    part = keys_of(buckets)
    return (
        buckets.where(F.col("last_key") >= 0)
        .groupBy(*part, "tr_id")
        .agg(F.max(F.struct("bucket", "last_key")).alias("last"))
        .select(
            *part,
            bucket_of("tr_id", gap).alias("first_bucket"),
            (F.col("last.last_key") % len(rule_keys())).alias("rule"),
        )
    )


def ruled_buckets(buckets: DataFrame, gap: int = MAX_ID_GAP) -> DataFrame:
    """Buckets of bursts that have a rule, with the rule's code.

    Joined on the bucket a burst starts in, which names it as well as ``tr_id``
    does, and is not how the rules were grouped: both sides come straight from
    a shuffle, so a burst with very many buckets can be split.
    """
    part = keys_of(buckets)
    placed = buckets.select(
        *part, "bucket", "tr_id", bucket_of("tr_id", gap).alias("first_bucket")
    )
    return join_by(placed, burst_rules(buckets, gap), part + ["first_bucket"])


def flag_regrades(adj: DataFrame, buckets: DataFrame, gap: int = MAX_ID_GAP) -> DataFrame:
    """Suspicious adjustments with ``tr_id`` and ``case1``, given ``burst_buckets``.

    Only good-state movements with a rule's reason reach the join.
    """
    part = keys_of(adj)
    texts = rule_keys()
    candidates = adj.where(
        F.col("reason").isin(list(OPPOSITE_REASON)) & F.col("disposition").isin(GOOD_STATES)
    ).withColumn("bucket", bucket_of(gap=gap))
    opposite = F.get(
        F.array(*[F.lit(OPPOSITE_REASON[t[0]]) for t in texts]), F.col("rule").cast("int")
    )
    key_text = F.get(F.array(*map(F.lit, texts)), F.col("rule").cast("int"))
    return (
        join_by(candidates, ruled_buckets(buckets, gap), part + ["bucket"])
        .where(F.col("reason") == opposite)
        .select(
            *adj.columns,
            "tr_id",
            F.concat(key_text, F.lit(":"), movement_case()).alias("case1"),
        )
    )


def detect_regrades(adj: DataFrame, gap: int = MAX_ID_GAP, fanout: int = FANOUT) -> DataFrame:
    """Suspicious adjustments among ``adj``. Clip dates first."""
    return flag_regrades(adj, burst_buckets(adj, gap, fanout), gap)


def regrade_sums(flagged: DataFrame) -> DataFrame:
    """Re-graded quantity per product."""
    keys = keys_of(flagged, "fnsku")
    return (
        flagged.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("17_Regraded_to_sell"))
    )
