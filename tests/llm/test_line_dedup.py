import duckdb
import pytest

from common import empty_documents, lower_ascii, odd_documents
from stockrecon.llm import registry
from stockrecon.llm.line_dedup import LineRuns, dedup_lines
from stockrecon.sources.scratch import Shelf

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    holders = {}
    for n, (doc_id, text) in enumerate(rows):
        for line in set((text or "").split("\n")):
            key = lower_ascii(line.strip(BLANKS))
            if len(key) >= min_chars:
                holders.setdefault(key, {})[n] = doc_id
    keep = {
        k: max((i for i in v.values() if i is not None), default=None)
        for k, v in holders.items() if len(v) >= min_docs
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc_id is None or keep.get(lower_ascii(x.strip(BLANKS)), doc_id) == doc_id
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


SHARED = "This line is in very many documents"
ROWS = [
    (1, f"{SHARED}\nonly here, and long enough\n{SHARED.upper()}  "),
    (2, f"\t{SHARED}\r\nshort\nshort"),
    (3, f"a{SHARED}\n\n"),
    (4, f"{SHARED}\n{SHARED}"),
    (5, "ééééééééééééééééééé"), (6, "ééééééééééééééééééé"), (7, "ééééééééééééééééééé"),
    (8, "éééééééééééééééééééé"), (9, "éééééééééééééééééééé\n"), (10, "\néééééééééééééééééééé"),
    (11, "in two documents only, then no more"), (12, "in two documents only, then no more"),
    (13, "short\nshort"), (14, "short"), (15, None), (16, ""),
]


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_against_brute_force(spark, batches):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted(map(tuple, dedup_lines(docs, batches=batches).collect()), key=repr)
    assert got == brute(ROWS)


def test_odd_documents(spark):
    docs = odd_documents(spark).unionByName(
        odd_documents(spark).selectExpr(
            "doc_id + 100 as doc_id", "text", "lang", "source", "n_chars", "size", "fp"
        )
    )
    docs = docs.unionByName(odd_documents(spark))
    got = sorted(map(tuple, dedup_lines(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert dedup_lines(empty_documents(spark)).count() == 0


def test_runs_move_up_and_leave_out_what_is_settled(spark):
    runs = LineRuns(Shelf(spark), min_docs=2, fan_in=2)
    batch = spark.createDataFrame([(9, 1, 1), (8, 1, 1), (7, 2, 2)], "doc_id long, h1 long, h2 long")
    runs.add(batch)
    runs.add(spark.createDataFrame([(5, 1, 1), (4, 2, 2)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [0, 1]
    assert sorted(map(tuple, runs.levels[1][0].collect())) == [(1, 1, 2, 9), (2, 2, 2, 7)]


def test_batches_meet_runs_and_runs_meet_without_an_exchange(spark, monkeypatch):
    """Only the combined batch is shuffled: one exchange for it, none for two runs."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = []
    put = Shelf.put_bucketed

    def noting(self, df, by, buckets):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, df, by, buckets)

    monkeypatch.setattr(Shelf, "put_bucketed", noting)
    try:
        runs = LineRuns(Shelf(spark), fan_in=3)
        for batch in range(4):
            ids = spark.range(1000 * (4 - batch), 1000 * (5 - batch))
            runs.add(ids.selectExpr("id as doc_id", "id % 100 as h1", "id % 700 as h2"))
        found = {(r.h1, r.h2): r.last for r in runs.settled().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Batches 1, 2, 3, their merge in two steps, batch 4, the last merge.
    assert [plan.count("Exchange") for plan in written][:4] == [1, 1, 1, 0]
    assert [plan.count("SortMergeJoin") for plan in written][:4] == [0, 1, 2, 1]
    holders = {}
    for i in range(1000, 5000):
        holders.setdefault((i % 100, i % 700), []).append(i)
    assert found == {k: max(v) for k, v in holders.items() if len(v) >= 3}


def test_query_and_sql_count_repeated_rows_alike(spark, tmp_path):
    """Two rows of one id and a third document make three; rows without an id keep all."""
    line = "a line that is long enough to count"
    rows = [(1, line), (1, line), (2, f"{line}\nshort"), (None, line), (3, "a line of two rows only"),
            (3, "a line of two rows only"), (4, f"{line} too"), (5, f"{line} too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.oracle_sql()["op7_line_dedup"]).fetchall()
    got = registry.op7_line_dedup(spark, str(tmp_path)).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[2] for r in want) == 2
