from conftest import rows
from pyspark.sql import functions as F

from stockrecon.operators.crosstab import of_reported_products
from stockrecon.operators.prefilter import key_words, may_match

KEYS = ["client", "fnsku"]


def _keyed(ids):
    """Three rows a product, of eight clients."""
    return ids.select(
        F.concat(F.lit("C"), F.col("id") % 8).alias("client"),
        F.concat(F.lit("X"), F.col("id")).alias("fnsku"),
        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("n"),
    )


def test_all_partners_pass_and_few_others(spark):
    adj = _keyed(spark.range(40_000))
    listed = _keyed(spark.range(0, 40_000, 40)).select(*KEYS)
    passed = may_match(adj, listed, KEYS, words=1_000)
    assert passed.columns == adj.columns
    wanted = adj.join(listed.distinct(), KEYS, "left_semi")
    assert passed.join(listed.distinct(), KEYS, "left_semi").count() == wanted.count() == 3_000
    assert passed.count() - 3_000 < 0.02 * 117_000


def test_full_words_let_rows_pass_but_lose_none(spark):
    adj = _keyed(spark.range(4_000))
    listed = _keyed(spark.range(2_000)).select(*KEYS)
    assert key_words(listed, words=4).count() == 4  # the bound of the broadcast side
    assert may_match(adj, listed, KEYS, words=4).count() >= 6_000
    report = listed.withColumnRenamed("fnsku", "00_fnsku")
    with_filter = of_reported_products(adj, report, prefilter=True)
    assert rows(with_filter) == rows(of_reported_products(adj, report))


def test_null_keys_empty_lists_and_other_types(spark):
    adj = spark.createDataFrame(
        [("a", "x", 1), ("a", None, 2), (None, "x", 3), ("b", "y", 4), ("", "", 5), ("b", "y", 4)],
        "client string, fnsku string, word long",
    )
    listed = spark.createDataFrame(
        [("a", "x"), (None, "x"), ("a", None), ("", ""), ("b", "y")], "client string, fnsku string"
    )
    report = listed.withColumnRenamed("fnsku", "00_fnsku")
    found = of_reported_products(adj, report, prefilter=True)
    assert rows(found, "word") == [(1,), (4,), (4,), (5,)]
    assert rows(found) == rows(of_reported_products(adj, report))
    assert may_match(adj, listed.limit(0), KEYS).count() == 0
    assert may_match(adj.limit(0), listed, KEYS).count() == 0
    numbers = spark.createDataFrame([(1,), (2,)], "fnsku long")
    texts = spark.createDataFrame([("1",), ("7",)], "fnsku string")
    assert may_match(texts, numbers, ["fnsku"]).count() == 2


def test_rows_are_filtered_before_they_are_shuffled(spark, tmp_path):
    _keyed(spark.range(4_000)).write.parquet(str(tmp_path / "adj"))
    _keyed(spark.range(40)).select("client", F.col("fnsku").alias("00_fnsku")).write.parquet(
        str(tmp_path / "report")
    )
    adj = spark.read.parquet(str(tmp_path / "adj"))
    report = spark.read.parquet(str(tmp_path / "report"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = of_reported_products(adj, report, prefilter=True)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        physical = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 120
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    # From the leaf upwards: scan, filter by words, exchange, join.
    order = [physical.index(x) for x in ("SortMergeJoin", "Exchange hashpartitioning(client", "BroadcastHashJoin")]
    assert order == sorted(order)
