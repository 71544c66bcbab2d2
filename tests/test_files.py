import io
import subprocess
import sys
import zipfile
from decimal import Decimal

import pytest
from conftest import rows
from golden import ADJ, AS_OF, REC, REI, REPORT, REPORT_COLUMNS, frames
from pyspark.sql import functions as F

from stockrecon.plans.reconcile import reconcile
from stockrecon.sources import reports as csv_reports
from stockrecon.sources.archives import (
    archive_lines,
    archive_members,
    package_status,
    reports_from_lines,
)
from stockrecon.sources.packages import allowed_only, name_clients
from stockrecon.sources.reports import read_packages, read_report
from stockrecon.sources import sinks
from stockrecon.sources.sinks import read_results, write_results
from stockrecon.streaming import pickup
from stockrecon.streaming.pickup import stream_packages

REC_HEAD = "sku,fnsku,asin,product-name,condition,discrepant-quantity,quantity"
ADJ_HEAD = (
    "transaction-item-id,adjusted-date,fnsku,fulfillment-center-id,reason,disposition,quantity"
)
REI_HEAD = "approval-date,fnsku,reason,quantity-reimbursed-total,quantity-reimbursed-inventory"


def text(head, data):
    return "\n".join([head, *[",".join(map(str, r)) for r in data]]) + "\n"


def package_files():
    return {
        "direct_REC_1.csv": text(REC_HEAD, REC),
        "x-adj 2.CSV": text(ADJ_HEAD, ADJ),
        "x_rei.csv": text(REI_HEAD, REI),
    }


def write_folder(root, client, files):
    folder = root / client
    folder.mkdir(parents=True)
    for name, content in files.items():
        (folder / name).write_bytes(
            content if isinstance(content, bytes) else content.encode("latin1")
        )


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files.items():
            z.writestr(name, content)
    return out.getvalue()


def test_folders_of_csv_files_end_in_the_same_report(spark, tmp_path):
    write_folder(tmp_path, "acme", package_files())
    write_folder(tmp_path, "two words+plus", package_files())
    write_folder(tmp_path, "short", {"x_rec.csv": text(REC_HEAD, REC), "x_adj.csv": ADJ_HEAD})
    write_folder(tmp_path, "double", {**package_files(), "y rec.csv": text(REC_HEAD, REC)})
    found = read_packages(spark, str(tmp_path))
    assert rows(found["status"], "client", "status") == [
        ("acme", "ok"), ("double", "several files for rec"), ("short", "no file for rei"),
        ("two words+plus", "ok"),
    ]
    report = reconcile(found["rec"], found["adj"], found["rei"], AS_OF)["df_rec"]
    for client in ("acme", "two words+plus"):
        got = report.where(F.col("client") == client).select(
            *[f"`{c}`" for c in REPORT_COLUMNS]
        )
        assert [tuple(r) for r in got.collect()] == REPORT
    assert {r["client"] for r in report.select("client").distinct().collect()} == {
        "acme", "two words+plus",
    }


def test_ragged_rows_quotes_bytes_null_words_and_column_order(spark, tmp_path):
    content = (
        "\n" + REC_HEAD + ",ending-balance\n"
        'S1,X1,B1,"caf\xe9, large",NEW,1,2,3\n'
        "S2,X2,B2,too long,NEW,1,2,3,4\n"
        "S3,X3,B3,too long after a gap,NEW,1,2,3,,5\n"
        "S4,X4,B4,short\n"
        "S5,X5,B5,NULL,n/a,12.0,nan,x\n"
        'S6,X6,B6,"say ""hi""",NEW,-4,,7\n'
        'S7,X7,B7,"two\nlines, still one",NEW,5,6,12.5\n'
        "S8,X8,B8,one blank too many,NEW,1,2,3,\n"
        "S8,X8,B8,three blanks too many,NEW,1,2,3,,,\n"
        f"S8,X8,B8,far too long,NEW,1,2,3{',' * 30}9\n"
        'S8,X8,B8,"too\nlong, too",NEW,1,2,3,4\n'
    )
    write_folder(tmp_path, "a", {"r-rec.csv": content})
    write_folder(tmp_path, "b", {"r-rec.csv": "fnsku,extra,sku\nX9,8,S9\n"})
    got = read_report(spark, f"{tmp_path}/*/*", "rec", count_columns=("ending_balance",))
    types = dict(got.dtypes)
    assert types["ending_balance"] == "decimal(38,6)" and types["extra"] == "string"
    names = ["client", "sku", "fnsku", "product_name", "condition", "discrepant_quantity",
             "quantity", "ending_balance", "extra"]
    assert rows(got, *names) == sorted([
        ("a", "S1", "X1", "caf\xe9, large", "NEW", 1, 2, 3, None),
        ("a", "S4", "X4", "short", None, None, None, None, None),
        ("a", "S5", "X5", None, None, 12, None, None, None),
        ("a", "S6", "X6", 'say "hi"', "NEW", -4, None, 7, None),
        ("b", "S9", "X9", None, None, None, None, None, "8"),
        ("a", "S7", "X7", "two\nlines, still one", "NEW", 5, 6, Decimal("12.5"), None),
    ], key=repr)


def test_known_columns_skip_the_header_pass(spark, tmp_path, monkeypatch):
    write_folder(tmp_path, "a", package_files())
    slow = read_report(spark, f"{tmp_path}/*/*", "adj")
    monkeypatch.setattr(csv_reports, "file_headers", None)
    fast = read_report(
        spark, f"{tmp_path}/*/*", "adj", columns=ADJ_HEAD.split(","), multi_line=False
    )
    assert rows(fast) == rows(slow) and fast.count() == len(ADJ)


BAD_CRC = bytearray(zipped(package_files()))
BAD_CRC[80] ^= 0xFF

ARCHIVES = {
    "good": zipped(package_files()),
    "folder": zipped({f"inside/{n}": c for n, c in package_files().items()}),
    "mac": zipped(
        {f"inside/{n}": c for n, c in package_files().items()}
        | {"__MACOSX/inside/._x": b"junk"}
    ),
    "nested": zipped({"inner.zip": zipped(package_files())}),
    "bare": zipped({"rec.csv": text(REC_HEAD, REC), "adj.csv": ADJ_HEAD, "rei.csv": REI_HEAD}),
    "four": zipped({**package_files(), "notes.txt": "hello"}),
    "two": zipped({"a_rec.csv": REC_HEAD, "a_adj.csv": ADJ_HEAD}),
    "same": zipped({"a_rec.csv": REC_HEAD, "b_rec.csv": REC_HEAD, "c_adj.csv": ADJ_HEAD}),
    "deep": zipped({"a_rec.csv": REC_HEAD, "b_adj.csv": ADJ_HEAD, "in/c_rei.csv": REI_HEAD}),
    "empty": zipped({}),
    "text": b"not a zip at all",
    "crc": bytes(BAD_CRC),
}
USABLE = ["bare", "folder", "good", "mac", "nested"]


def archive_frame(spark):
    return spark.createDataFrame(
        [(k, f"{k}.zip", bytearray(v)) for k, v in ARCHIVES.items()],
        "client string, archive string, content binary",
    )


def test_verdict_on_each_package(spark):
    verdict = dict(rows(package_status(archive_members(archive_frame(spark))), "client", "status"))
    assert {c for c, s in verdict.items() if s == "ok"} == set(USABLE)
    assert verdict["text"] == "not ZIP file attached"
    assert verdict["crc"] == "crc.zip - brocken *.zip"
    for name in ("four", "two", "same", "deep", "empty"):
        assert verdict[name] == "not three files in ZIP"


def test_reports_out_of_archives(spark):
    good = archive_frame(spark).where(F.col("client").isin(USABLE))
    found = reports_from_lines(archive_lines(good))
    per_client = dict(rows(found["adj"].groupBy("client").count()))
    assert per_client == {c: len(ADJ) for c in USABLE if c != "bare"}
    one = [found[k].where("client = 'nested'") for k in ("rec", "adj", "rei")]
    report = reconcile(*one, AS_OF)["df_rec"].select(*[f"`{c}`" for c in REPORT_COLUMNS])
    assert [tuple(r) for r in report.collect()] == REPORT


def test_records_of_archives_may_hold_line_breaks(spark):
    content = zipped({
        "x_rec.csv": REC_HEAD + ",note\n"
        'S1,X1,B1,"two\n\nlines ""here""",NEW,-3,1,kept\r\n'
        "S2,X2,B2,long,NEW,-3,1,n,\n"
        "S3,X3,B3,short\n",
        "x_adj.csv": ADJ_HEAD + "\n",
        "x_rei.csv": REI_HEAD + "\n",
    })
    frame = spark.createDataFrame(
        [("c", "c.zip", bytearray(content))], "client string, archive string, content binary"
    )
    got = reports_from_lines(archive_lines(frame))["rec"]
    assert rows(got, "fnsku", "product_name", "discrepant_quantity", "note") == [
        ("X1", 'two\n\nlines "here"', -3, "kept"), ("X3", "short", None, None),
    ]


def test_plan_does_not_grow_with_the_number_of_layouts(spark):
    names = REC_HEAD.split(",")
    lines = []
    for i in range(1000):
        turn = names[i % 7 :] + names[: i % 7]
        quoted = [f'"{n}"' if (i // 7) >> k & 1 else n for k, n in enumerate(turn)]
        head = ",".join(quoted + [f"pad-{k}" for k in range(i % 5)])
        cells = {"fnsku": f"X{i}", "discrepant-quantity": str(i)}
        line = ",".join(cells.get(n, "t") for n in turn)
        lines.append(("c", "a", f"f{i}_rec.csv", head, line))
    assert len({line[3] for line in lines}) == 1000

    def report(data):
        frame = spark.createDataFrame(
            data, "client string, archive string, name string, header string, line string"
        )
        return reports_from_lines(frame)["rec"]

    many = report(lines)
    assert rows(many, "fnsku", "discrepant_quantity") == sorted((f"X{i}", i) for i in range(1000))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(many) < 1.5 * size(report(lines[:35]))


def test_workers_find_the_package_from_another_folder(tmp_path):
    root = __file__.rsplit("/tests/", 1)[0]
    (tmp_path / "job.py").write_text(
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from stockrecon.sources.archives import archive_members\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "f = s.createDataFrame([('c', 'c.zip', bytearray(b'x'))],"
        " 'client string, archive string, content binary')\n"
        "print('found', archive_members(f).count())\n"
    )
    done = subprocess.run(
        [sys.executable, "job.py", root], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "found 1" in done.stdout, done.stderr[-2000:]


def test_client_names_from_subjects(spark):
    mail = spark.createDataFrame(
        [
            (1, "Re: Fwd: Acme report", "2024-01-01 10:00:00"),
            (2, "Acme", "2024-01-01 09:00:00"),
            (3, "Fwd:Acme again", "2024-01-02 10:00:00"),
            (4, "Acme", "2024-01-02 10:00:00"),
            (5, "", "2024-01-01 10:00:00"),
            (6, "Re:  ", "2024-01-03 10:00:00"),
            (7, "old one", "2024-01-03 10:00:00"),
        ],
        "package long, subject string, arrived string",
    ).withColumn("arrived", F.col("arrived").cast("timestamp"))
    seen = spark.createDataFrame([("old",)], "client string")
    crowd = mail.where("package = 4").select(
        F.explode(F.sequence(F.lit(100), F.lit(5099))).alias("package"), "subject", "arrived"
    ).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        many = name_clients(mail.unionByName(crowd), seen)
        named = dict(many.select("package", "client").collect())
        assert named[4] == "Acme_240102_100000_2" and named[3] == "Acme_240102_100000"
        assert all(named[p] == f"Acme_240102_100000_{p - 97}" for p in range(100, 5100))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert rows(name_clients(mail, seen), "package", "client") == [
        (1, "Acme_240101_100000"), (2, "Acme"), (3, "Acme_240102_100000"),
        (4, "Acme_240102_100000_2"), (5, "was_no_subj_"), (6, "was_no_subj__240103_100000"),
        (7, "old_240103_100000"),
    ]


def test_allow_list_is_trimmed(spark):
    mail = spark.createDataFrame([("a@x",), ("b@x",), ("a@x",)], "sender string")
    listed = spark.createDataFrame([("  a@x ",), ("c@x",), ("a@x",)], "sender string")
    assert rows(allowed_only(mail, listed)) == [("a@x",), ("a@x",)]


def test_written_results_equal_the_lazy_ones_and_can_be_repeated(spark, tmp_path):
    write_folder(tmp_path / "in", "acme", package_files())
    found = read_packages(spark, str(tmp_path / "in"))
    inputs = [found[k] for k in ("rec", "adj", "rei")]
    lazy = reconcile(*inputs, AS_OF)
    for _ in range(2):
        written = write_results(*inputs, AS_OF, str(tmp_path / "out"), run=3)
    for name, df in lazy.items():
        assert sorted(written[name].columns) == sorted(df.columns)
        assert rows(written[name], *df.columns) == rows(df)
    assert rows(written["outcome"], "client", "outcome") == [("acme", "Macros reply - Ok")]
    assert written["pivot"].count() == 13
    tries = list((tmp_path / "out" / "report" / "run=3").iterdir())
    assert len(tries) == 1 and (tries[0] / "client=acme").is_dir()  # the repeat replaced the first
    shown = read_results(spark, str(tmp_path / "out"), "report")
    assert rows(shown.drop("run"), *lazy["df_rec"].columns) == rows(lazy["df_rec"])
    assert {r["run"] for r in shown.collect()} == {"3"}
    assert read_results(spark, str(tmp_path / "none"), "report") is None
    assert read_results(spark, str(tmp_path / "out"), "status") is None


def test_a_run_that_fails_between_two_tables_is_not_seen(spark, tmp_path, monkeypatch):
    write_folder(tmp_path / "in", "acme", package_files())
    write_folder(tmp_path / "in", "007", package_files())
    found = read_packages(spark, str(tmp_path / "in"))
    inputs = [found[k] for k in ("rec", "adj", "rei")]
    out = str(tmp_path / "out")
    write_results(*inputs, AS_OF, out, run="1")
    before = {t: rows(read_results(spark, out, t)) for t in ("report", "adjustments", "outcome")}
    shelves = folders(shelf_root(spark))

    def fail(*_):
        raise RuntimeError("lost")

    for run in ("1", "2"):
        with monkeypatch.context() as patch:
            patch.setattr(sinks, "pivot_long", fail)  # report and crosstab are there by then
            with pytest.raises(RuntimeError):
                write_results(*inputs, AS_OF, out, run=run)
        with monkeypatch.context() as patch:  # not even what a killed process leaves
            patch.setattr(sinks, "pivot_long", fail)
            patch.setattr(sinks.Run, "discard", lambda self: None)
            with pytest.raises(RuntimeError):
                write_results(*inputs, AS_OF, out, run=run)
        assert {t: rows(read_results(spark, out, t)) for t in before} == before
    assert folders(shelf_root(spark)) == shelves
    write_results(*inputs, AS_OF, out, run="2")
    report = read_results(spark, out, "report")
    assert rows(report.where("run = '2'").drop("run")) == rows(report.where("run = '1'").drop("run"))
    assert {r["client"] for r in report.collect()} == {"acme", "007"}


def test_stream_takes_each_package_once(spark, tmp_path):
    landing, out, mark = (str(tmp_path / d) for d in ("landing", "out", "mark"))

    def drop(subject, name, content):
        write_folder(tmp_path / "landing", subject, {name: content})

    def pick_up():
        query = stream_packages(spark, landing, out, mark, as_of=AS_OF, once=True)
        query.awaitTermination()
        assert query.exception() is None
        return read_results(spark, out, "report")

    drop("Acme report", "pack.zip", ARCHIVES["mac"])
    drop("Broken", "pack.zip", ARCHIVES["crc"])
    first = pick_up()
    shown = [f"`{c}`" for c in REPORT_COLUMNS]
    assert sorted(map(tuple, first.select(*shown).collect()), key=repr) == sorted(REPORT, key=repr)
    assert pick_up().count() == 4  # nothing new, nothing added
    drop("Acme again", "more.zip", ARCHIVES["good"])
    again = pick_up()
    assert again.count() == 8
    names = {r["client"] for r in again.select("client").distinct().collect()}
    assert "Acme" in names and len(names) == 2
    assert all(n == "Acme" or n.startswith("Acme_") for n in names)
    status = rows(read_results(spark, out, "status"), "client", "status")
    assert ("Broken", "pack.zip - brocken *.zip") in status and len(status) == 3


def folders(path):
    return sorted(p.name for p in path.glob("*/shelf-*"))


def test_two_checkpoints_share_an_output(spark, tmp_path):
    before = folders(shelf_root(spark))
    for turn, subject in enumerate(["Acme report", "Other report"]):
        landing = tmp_path / f"landing{turn}"
        write_folder(landing, subject, {"pack.zip": ARCHIVES["good"]})
        query = stream_packages(
            spark, str(landing), str(tmp_path / "out"), str(tmp_path / f"mark{turn}"),
            as_of=AS_OF, once=True,
        )
        query.awaitTermination()
        assert query.exception() is None
    report = read_results(spark, str(tmp_path / "out"), "report")
    assert {r["client"] for r in report.select("client").distinct().collect()} == {"Acme", "Other"}
    assert folders(shelf_root(spark)) == before  # nothing stored is left


def shelf_root(spark):
    from pathlib import Path

    from stockrecon.sources.scratch import ensure_checkpoint_dir

    return Path(ensure_checkpoint_dir(spark).removeprefix("file:")).parent


def run_stream(spark, tmp_path, **options):
    query = stream_packages(
        spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "mark"),
        as_of=AS_OF, once=True, **options,
    )
    query.awaitTermination()
    return query


def test_taken_files_leave_with_the_commit(spark, tmp_path):
    landing, kept = tmp_path / "landing", tmp_path / "kept"
    for turn in range(2):
        write_folder(landing, f"Acme{turn}", {"pack.zip": ARCHIVES["good"]})
        assert run_stream(spark, tmp_path, archive_to=str(kept)).exception() is None
        assert not list(landing.rglob("*.zip"))
    assert sorted(p.parent.name for p in kept.rglob("*.zip")) == ["Acme0", "Acme1"]
    write_folder(landing, "Acme2", {"pack.zip": ARCHIVES["good"]})
    assert run_stream(spark, tmp_path, remove_taken=True).exception() is None
    assert not list(landing.rglob("*.zip"))
    report = read_results(spark, str(tmp_path / "out"), "report")
    assert report.count() == 12 and report.select("run").distinct().count() == 3


def test_a_batch_that_fails_keeps_its_files_and_one_that_was_committed_is_not_repeated(
    spark, tmp_path, monkeypatch
):
    landing = tmp_path / "landing"
    write_folder(landing, "Acme", {"pack.zip": ARCHIVES["good"]})
    shelves = folders(shelf_root(spark))

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "pivot_long", fail)
        with pytest.raises(Exception, match="lost"):
            run_stream(spark, tmp_path, remove_taken=True)
    assert len(list(landing.rglob("*.zip"))) == 1
    assert read_results(spark, str(tmp_path / "out"), "report") is None
    assert folders(shelf_root(spark)) == shelves
    with monkeypatch.context() as patch:  # committed, then lost before the files were removed
        patch.setattr(pickup, "clear_taken", fail)
        with pytest.raises(Exception, match="lost"):
            run_stream(spark, tmp_path, remove_taken=True)
    assert len(list(landing.rglob("*.zip"))) == 1
    with monkeypatch.context() as patch:
        patch.setattr(pickup, "reconcile_batch", fail)  # not called again
        assert run_stream(spark, tmp_path, remove_taken=True).exception() is None
    assert not list(landing.rglob("*.zip"))
    assert read_results(spark, str(tmp_path / "out"), "report").count() == 4


def test_results_of_one_client_without_a_name(spark, tmp_path):
    inputs = frames(spark)
    written = write_results(*inputs, AS_OF, str(tmp_path / "out"))
    got = written["df_rec"].select(*[f"`{c}`" for c in REPORT_COLUMNS])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(REPORT, key=repr)
    assert rows(written["outcome"], "outcome") == [("Macros reply - Ok",)]
