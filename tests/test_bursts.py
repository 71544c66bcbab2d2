import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stockrecon.operators.bursts import assign_bursts, assign_bursts_window, burst_buckets
from stockrecon.operators.regrades import detect_regrades
from stockrecon.functions.text import rule_keys

GAP = 10_000
BASE = 20_285_364_484_018_375  # 17 digits, beyond exact doubles


def random_cases(count, seed):
    """Clients with ids that sit on, just over and far from the gap and bucket edges."""
    rng = random.Random(seed)
    out = []
    for n in range(count):
        at = rng.choice([0, 1, -75_000, BASE, 7 * GAP])
        for _ in range(rng.randint(1, 40)):
            out.append((f"c{n}", at))
            at += rng.choice([0, 1, 500, GAP - 1, GAP, GAP, GAP + 1, 3 * GAP, 12 * GAP])
    rng.shuffle(out)
    return out


def expected(ids):
    """Bursts of one client by walking its ids."""
    ids = sorted(ids)
    runs, out = [], []
    for i in ids:
        if runs and i - runs[-1][-1] <= GAP:
            runs[-1].append(i)
        else:
            runs.append([i])
    for run in runs:
        out += [(i, run[0] if len(run) > 1 else 0) for i in run]
    return out


@pytest.fixture(scope="module")
def cases(spark):
    data = random_cases(120, 7)
    df = spark.createDataFrame(data, "client string, transaction_item_id long").select(
        "*",
        F.lit("P").alias("reason"),
        F.lit("SELLABLE").alias("disposition"),
    )
    by_client = {}
    for c, i in data:
        by_client.setdefault(c, []).append(i)
    want = sorted(
        ((c, i, t) for c, ids in by_client.items() for i, t in expected(ids)), key=repr
    )
    return df, want


@pytest.mark.parametrize("fanout", [2, 5, 1 << 21])
def test_bucket_form_matches_a_walk_over_the_ids(cases, fanout):
    df, want = cases
    got = rows(assign_bursts(df, fanout=fanout), "client", "transaction_item_id", "tr_id")
    # a burst that starts at id 0 is named 0 like a lone row
    assert got == want


def test_window_form_matches_too(cases):
    df, want = cases
    assert rows(assign_bursts_window(df), "client", "transaction_item_id", "tr_id") == want


def test_without_client_and_without_id(spark):
    df = spark.createDataFrame(
        [(5, "P", "SELLABLE"), (10_005, "P", "SELLABLE"), (None, "P", "SELLABLE"),
         (20_006, "P", "SELLABLE")],
        "transaction_item_id long, reason string, disposition string",
    )
    want = sorted([(5, 5), (10_005, 5), (None, 0), (20_006, 0)], key=repr)
    assert rows(assign_bursts(df), "transaction_item_id", "tr_id") == want
    assert rows(assign_bursts_window(df), "transaction_item_id", "tr_id") == want


def test_scan_and_shuffle_of_buckets_run_once(spark, cases, tmp_path):
    df, _ = cases
    path = str(tmp_path / "adj")
    df.write.parquet(path)
    result = assign_bursts(spark.read.parquet(path))
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") - final.count("ReusedExchange") <= 2


def expected_regrades(data):
    """The last rule key of a burst decides; brute force over small groups."""
    good = {"SELLABLE", "DEFECTIVE", "DISTRIBUTOR_DAMAGED", "CUSTOMER_DAMAGED", "EXPIRED"}
    out = []
    for client in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == client), key=lambda d: d[1])
        burst_of = dict(expected([d[1] for d in mine]))
        for burst in set(burst_of.values()) - {0}:
            group = [d for d in mine if burst_of[d[1]] == burst]
            keys = [d for d in group if f"{d[2]}-{d[3]}" in rule_keys()]
            if not keys:
                continue
            last = max(keys, key=lambda d: (d[1], f"{d[2]}-{d[3]}"))
            key = f"{last[2]}-{last[3]}"
            other = "P" if key[0] == "Q" else "Q"
            out += [
                (client, d[1], burst, f"{key}:{d[2]}-{d[3]}")
                for d in group
                if d[2] == other and d[3] in good
            ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [2, 1 << 21])
def test_regrades_match_brute_force(spark, fanout):
    rng = random.Random(11)
    states = ["SELLABLE", "EXPIRED", "UNSELLABLE", "WAREHOUSE_DAMAGED", "CARRIER_DAMAGED", None]
    data = [
        (c, i, rng.choice(["P", "Q", "P", "Q", "M", None]), rng.choice(states))
        for c, i in random_cases(80, 3)
        if i != 0
    ]
    df = spark.createDataFrame(
        data, "client string, transaction_item_id long, reason string, disposition string"
    )
    got = rows(detect_regrades(df, fanout=fanout), "client", "transaction_item_id", "tr_id", "case1")
    assert got == expected_regrades(data)
    assert len(got) > 50


def test_one_burst_and_one_id_holding_most_rows(spark):
    """A dense client and a single crowded id give the same bursts in both forms."""
    dense = spark.range(60_000).select(
        F.lit("big").alias("client"),
        F.when(F.col("id") < 20_000, 777).otherwise(F.col("id") * 9_999).alias("transaction_item_id"),
        F.when(F.col("id") % 7 == 0, "Q").otherwise("P").alias("reason"),
        F.when(F.col("id") % 5 == 0, "UNSELLABLE").otherwise("SELLABLE").alias("disposition"),
    )
    a = assign_bursts(dense, fanout=64)
    b = assign_bursts_window(dense)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert burst_buckets(dense, fanout=64).select("tr_id").distinct().count() == 2


def test_adaptive_execution_splits_a_crowded_bucket(spark):
    """With tiny thresholds the join back to rows shows a split skewed partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows_ = spark.range(0, 80_000, numPartitions=8).select(
            F.when(F.col("id") % 3 != 0, 5).otherwise(F.col("id") * 40_000 + 70_000).alias(
                "transaction_item_id"
            ),
            F.lit("a").alias("client"),
            F.lit("P").alias("reason"),
            F.lit("SELLABLE").alias("disposition"),
            F.sha2(F.col("id").cast("string"), 256).alias("filler"),
        )
        result = assign_bursts(rows_)
        assert result.where("tr_id = 5").count() > 50_000
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan.split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
