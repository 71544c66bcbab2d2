import uuid

import pytest
from conftest import rows
from golden import AS_OF, REPORT, REPORT_COLUMNS, frames
from pyspark.sql import functions as F

from stockrecon.operators.bursts import burst_buckets
from stockrecon.operators.clip import clip_adjustments, clip_reimbursements
from stockrecon.operators.crosstab import of_reported_products
from stockrecon.operators.products import product_table
from stockrecon.operators.regrades import flag_regrades
from stockrecon.operators.sliced import SLICE, layout
from stockrecon.plans.reconcile import product_rows, reconcile
from stockrecon.sources import history
from stockrecon.sources.history import (
    add_to_history,
    compact_history,
    land_history,
    open_history,
    put_sums,
)
from stockrecon.sources.scratch import store
from stockrecon.sources.sinks import read_results, write_results


@pytest.fixture()
def no_broadcast(spark):
    """Joins as they are between large tables, plans without the adaptive wrapper."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _landed(tmp_path, *dfs, **options):
    return [land_history(df, str(tmp_path / uuid.uuid4().hex), **options) for df in dfs]


def _joins(df):
    """Every join of the plan: its two inputs as text."""
    found, open_ = [], [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        children = node.children()
        inputs = [children.apply(i) for i in range(children.size())]
        if "Join" in node.nodeName():
            found.append([x.toString() for x in inputs])
        open_ += inputs
    return found


@pytest.mark.parametrize("client, shared", [(None, True), ("acme", False)])
def test_runs_over_a_history_equal_runs_over_the_reports(spark, tmp_path, client, shared):
    rec, adj, rei = frames(spark, client)
    kept_rec, kept_adj = _landed(tmp_path, rec, adj, buckets=3, slices=4)
    plain = reconcile(rec, adj, rei, AS_OF)
    found = reconcile(kept_rec, kept_adj, rei, AS_OF, store_shared=shared)
    shown = found["df_rec"].select(*[f"`{c}`" for c in REPORT_COLUMNS])
    assert [tuple(r) for r in shown.collect()] == REPORT
    for name in plain:
        assert found[name].columns == plain[name].columns
        assert rows(found[name]) == rows(plain[name])


def test_written_results_of_a_history(spark, tmp_path):
    rec, adj, rei = frames(spark, "acme")
    kept_rec, kept_adj = _landed(tmp_path, rec, adj)
    out = str(tmp_path / "out")
    write_results(kept_rec, kept_adj, rei, AS_OF, out, run="r1")
    plain = reconcile(rec, adj, rei, AS_OF)
    for table, name in (("report", "df_rec"), ("adjustments", "df_adj_filtered")):
        found = read_results(spark, out, table).drop("run").select(*[f"`{c}`" for c in plain[name].columns])
        assert rows(found) == rows(plain[name])


def test_stock_meets_stored_sums_without_a_shuffle(spark, tmp_path, no_broadcast):
    rec, adj, rei = frames(spark, "acme")
    adj, rei = clip_adjustments(adj, AS_OF), clip_reimbursements(rei, AS_OF)
    table = product_table(adj, rei, flag_regrades(adj, burst_buckets(adj)))
    (kept,) = _landed(tmp_path, rec, buckets=4)
    sums = put_sums(table, kept, str(tmp_path / "sums"))
    found = product_rows(kept, sums)
    stock_join = [j for j in _joins(found) if all("Exchange" not in side for side in j)]
    assert len(stock_join) == 1
    assert rows(found.select(*sorted(product_rows(rec, table).columns))) == rows(
        product_rows(rec, table).select(*sorted(product_rows(rec, table).columns))
    )


def test_adjustments_stay_where_they_are(spark, tmp_path, no_broadcast):
    _, adj, _ = frames(spark, "acme")
    (kept,) = _landed(tmp_path, adj, buckets=4)
    # Stored, or the optimizer sees that there is one client and joins by product alone.
    report = store(adj.where("fnsku <> 'X1'").select("client", F.col("fnsku").alias("00_fnsku")))
    found = of_reported_products(kept, report)
    (sides,) = _joins(found)
    assert "Exchange" not in sides[0] and "Exchange" in sides[1]
    assert rows(found) == rows(adj.where("fnsku <> 'X1'").select(*found.columns))


def test_a_hot_product_and_its_copies_lie_in_many_slices(spark, tmp_path):
    _, adj, _ = frames(spark, "acme")
    one = adj.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(4_000))).alias("copy"))
    hot = one.drop("copy").repartition(16)  # the same row again and again
    (kept,) = _landed(tmp_path, hot, buckets=4, slices=4)
    shares = kept.groupBy(SLICE).count().collect()
    assert sum(r["count"] for r in shares) == 4_000
    assert len(shares) > 1 and max(r["count"] for r in shares) < 3_000


def test_sums_come_once_unless_their_product_is_crowded(spark, tmp_path):
    rows_of = F.when(F.col("id") == 0, 3_000).when(F.col("id") < 100, 20).otherwise(1)
    product = F.when(F.col("id") < 120, F.concat(F.lit("X"), "id")).alias("fnsku")
    many = spark.range(121).select(
        F.lit("a").alias("client"), product,
        F.explode(F.sequence(F.lit(1), rows_of)).alias("n"),
    )
    path = str(tmp_path / "kept")
    kept = land_history(many, path, buckets=4, slices=4)
    sums = many.groupBy("client", "fnsku").agg(F.count("*").alias("rows")).where("fnsku is not null")
    stored = put_sums(sums, kept, str(tmp_path / "sums"))
    copies = {r["fnsku"]: r["count"] for r in stored.groupBy("fnsku").count().collect()}
    assert copies.pop("X0") == 4
    assert len(copies) == 119 and set(copies.values()) == {1}
    joined = kept.join(stored, ["client", "fnsku", SLICE])
    assert joined.count() == many.dropna().count()
    # A product that a later landing makes crowded meets its sums in all landings.
    later = many.where("fnsku = 'X1'").limit(1).select(
        "client", "fnsku", F.explode(F.sequence(F.lit(1), F.lit(4_000))).alias("n")
    )
    grown = add_to_history(later.repartition(4), path)
    stored = put_sums(sums, grown, str(tmp_path / "more"))
    assert stored.where("fnsku = 'X1'").count() == 4
    assert grown.join(stored, ["client", "fnsku", SLICE]).count() == many.dropna().count() + 4_000
    listed = sums.where("fnsku in ('X0', 'X1', 'X5')").withColumnRenamed("fnsku", "00_fnsku")
    found = of_reported_products(grown, listed)
    assert found.count() == 3_000 + 20 + 4_000 + 20 and found.columns == many.columns


def test_a_history_opens_again_and_keeps_nulls_and_odd_names(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", None, 1), (None, "x", 2), (None, None, None), ("a", "x", 1), ("a", "x", 1)],
        "client string, fnsku string, `odd name` long",
    )
    path = str(tmp_path / "kept")
    land_history(df, path, buckets=2, slices=3)
    found = open_history(spark, path)
    assert layout(found) == (3, 2)
    assert rows(found.drop(SLICE)) == rows(df)
    empty = land_history(df.limit(0), str(tmp_path / "empty"))
    assert empty.count() == 0 and empty.columns == [*df.columns, SLICE]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def _in_parts(df, path, parts=3, **options):
    """A history that grew: rows dealt to landings by their content."""
    part = F.pmod(F.xxhash64(*[f"`{c}`" for c in df.columns]), F.lit(parts))
    land_history(df.where(part == 0), path, **options)
    for i in range(1, parts):
        found = add_to_history(df.where(part == i), path)
    return found


@pytest.mark.parametrize("compacted", [False, True])
def test_runs_over_a_history_that_grew(spark, tmp_path, compacted):
    rec, adj, rei = frames(spark, "acme")
    paths = [str(tmp_path / name) for name in ("rec", "adj")]
    kept = [_in_parts(df, path, buckets=3, slices=4) for df, path in zip((rec, adj), paths)]
    if compacted:
        kept = [compact_history(spark, path) for path in paths]
    plain, found = reconcile(rec, adj, rei, AS_OF), reconcile(*kept, rei, AS_OF)
    for name in plain:
        assert rows(found[name]) == rows(plain[name])


def test_landings_are_not_moved_and_their_buckets_meet(spark, tmp_path, no_broadcast):
    rec, adj, rei = frames(spark, "acme")
    adj, rei = clip_adjustments(adj, AS_OF), clip_reimbursements(rei, AS_OF)
    table = product_table(adj, rei, flag_regrades(adj, burst_buckets(adj)))
    kept = _in_parts(rec, str(tmp_path / "rec"), buckets=4)
    sums = put_sums(table, kept, str(tmp_path / "sums"))
    found = product_rows(kept, sums)
    assert len([j for j in _joins(found) if all("Exchange" not in side for side in j)]) == 1
    plain = product_rows(rec, table)
    assert rows(found.select(*sorted(plain.columns))) == rows(plain.select(*sorted(plain.columns)))
    # The same product in all landings is one group.
    copies = str(tmp_path / "copies")
    land_history(rec, copies, buckets=4, slices=1)
    twice = add_to_history(rec, copies).groupBy("client", "fnsku", SLICE).count()
    once = rec.groupBy("client", "fnsku").agg((2 * F.count("*")).alias("count"))
    assert rows(twice.drop(SLICE)) == rows(once)


def test_landings_by_name_and_only_whole_ones(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "kept")
    land_history(spark.createDataFrame([("x", 1)], "fnsku string, n long"), path, buckets=2)
    add_to_history(spark.createDataFrame([("2", "y")], "n string, fnsku string"), path)
    add_to_history(spark.createDataFrame([(None,), ("x",)], "fnsku string"), path)
    want = sorted([(None, None), ("x", None), ("x", 1), ("y", 2)], key=repr)
    assert sorted(map(tuple, open_history(spark, path).drop(SLICE).collect()), key=repr) == want
    with pytest.raises(ValueError, match="other"):
        add_to_history(spark.createDataFrame([("x", 1)], "fnsku string, other long"), path)
    with pytest.raises(ValueError, match="add_to_history"):
        land_history(spark.createDataFrame([("x", 1)], "fnsku string, n long"), path)

    write = history.write_bucketed

    def torn(df, *args):
        write(df, *args)
        raise RuntimeError("lost after the rows were written")

    monkeypatch.setattr(history, "write_bucketed", torn)
    with pytest.raises(RuntimeError):
        add_to_history(spark.createDataFrame([("z", 9)], "fnsku string, n long"), path)
    with pytest.raises(RuntimeError):
        compact_history(spark, path)
    monkeypatch.undo()
    assert sorted(map(tuple, open_history(spark, path).drop(SLICE).collect()), key=repr) == want
    compact_history(spark, path)
    again = add_to_history(spark.createDataFrame([("z", 9)], "fnsku string, n long"), path)
    assert sorted(map(tuple, again.drop(SLICE).collect()), key=repr) == sorted(
        [*want, ("z", 9)], key=repr
    )
