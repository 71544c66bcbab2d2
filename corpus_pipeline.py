"""From raw documents to token counts: five stages, each written and read again."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.llm import bpe, exact_dedup, mixing, quality, registry, simhash
from stockrecon.sources.scratch import Shelf


def _one_row(spark: SparkSession, docs: DataFrame, nulls_first: bool) -> tuple[DataFrame, str]:
    """``docs`` and a column that tells its rows apart, in the order of ``doc_id``.

    That is ``doc_id`` itself unless ids are missing or repeated; then rows are
    sorted and numbered, those without an id first or last.
    """
    odd = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    if not odd.limit(1).count():
        return docs, "doc_id"
    number = "row_number"
    while number in docs.columns:
        number += "_"
    by_id = F.asc_nulls_first("doc_id") if nulls_first else F.asc_nulls_last("doc_id")
    rest = [c for c in docs.columns if c != "doc_id"]
    numbered = docs.orderBy(by_id, *rest).withColumn(number, F.monotonically_increasing_id())
    return Shelf(spark).put(numbered), number


def _only(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is in ``ids``."""
    columns = [c for c in docs.columns if key == "doc_id" or c != key]
    return docs.join(ids, key, "left_semi").select(*columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier scores below the threshold."""
    model = registry.quality_model(spark, docs, sf_dir)
    return quality.keep_good(docs, model, threshold=registry.QUALITY_THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest id, one row if several have it."""
    docs, key = _one_row(spark, docs, nulls_first=True)
    groups = exact_dedup.exact_groups(docs, id_col=key, keep="largest")
    return _only(docs, groups.select(F.col("keep_id").alias(key)), key)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, keep the one with the smallest id."""
    docs, key = _one_row(spark, docs, nulls_first=False)
    found = simhash.near_duplicates(docs, id_col=key)
    return _only(docs, found.where("doc_id = component_id").select(F.col("doc_id").alias(key)), key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target words."""
    return mixing.expand(docs, Shelf(spark).put(mixing.mix(docs)))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.round_trip(docs, registry.ranks_path())


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("byte-level BPE", tokenize),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and reread."""
    shelf = Shelf(spark)
    docs = registry.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        print(f"pipeline: {name}", file=sys.stderr)
        docs = shelf.put(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
