"""The record automaton against a plain state machine, and files cut by many tasks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_files import ADJ_HEAD, REC_HEAD, REI_HEAD, write_folder, zipped

from stockrecon.sources.archives import archive_contents, losses_from_lines, reports_from_lines
from stockrecon.sources.archives import lines_of, members_of
from stockrecon.sources.records import (
    block_states,
    cell_text,
    cells_of,
    cut_records,
    file_lines,
    leaves_open,
    records_of,
    still_open,
)
from stockrecon.sources.reports import read_packages, read_report


def machine(text, whole_file=True):
    """Records of cells, character by character."""
    records, record, cell, state = [], [], "", "start"
    at = 0
    while at < len(text):
        c = text[at]
        at += 1
        if state == "quoted":
            if c == '"':
                state = "seen"
            else:
                cell += c
            continue
        if state == "seen" and c == '"':
            cell, state = cell + c, "quoted"
        elif c == '"' and state == "start":
            state = "quoted"
        elif c == ",":
            record, cell, state = [*record, cell], "", "start"
        elif c in "\r\n":
            at += c == "\r" and text[at : at + 1] == "\n"
            records.append([*record, cell])
            record, cell, state = [], "", "start"
        else:
            cell, state = cell + c, "plain"
    if record or cell or state != "start":
        if state == "quoted" and whole_file:  # never closed: the end of the file closes it
            cell = cell.removesuffix("\n").removesuffix("\r")
        records.append([*record, cell])
    return records, state


def blank(record):
    return len(record) == 1 and not record[0].strip()


def samples():
    pick = random.Random(5)
    return ["".join(pick.choice('",\n\r ab') for _ in range(pick.randrange(1, 40))) for _ in range(600)]


LINES = [
    "", '"', '""', '"""', 'a"b', '5" pipe,x', 'x,5" pipe', '"a,b', '"a""b",c', '"a"b"c",d', ' "a,b"',
    'a,"b', '"a",b"c', '"a""', 'a,"b""', ',"', '",', '"a" "b,c', "," * 50, '"' * 300, '"' * 301,
]


def test_open_quotes_of_a_line(spark):
    lines = LINES + [t.replace("\n", "x").replace("\r", "y") for t in samples()]
    frame = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    got = rows(
        frame.select("i", leaves_open(F.col("line")), leaves_open(F.concat(F.lit('"'), "line")))
    )
    want = [(i, machine(t)[1] == "quoted", machine('"' + t)[1] == "quoted") for i, t in enumerate(lines)]
    assert got == sorted(want, key=repr)
    assert [(still_open(t, False), still_open(t, True)) for t in lines] == [w[1:] for w in want]


def test_cells_of_a_record(spark):
    lines = LINES + [t.replace("\n", "x").replace("\r", "y") for t in samples()]
    frame = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    got = dict(frame.select("i", F.transform(cells_of(F.col("line")), cell_text)).collect())
    for i, line in enumerate(lines):
        want = machine(line)[0]
        assert got[i] == (want[0] if want else [""]), line


def test_records_of_lines():
    for text in samples() + [t + "\n" + t for t in LINES]:
        lines = text.splitlines(keepends=True)
        joined = [machine(r, False)[0] for r in records_of(iter(lines))]
        got = [r[0] for r in joined if r]
        assert [r for r in got if not blank(r)] == [r for r in machine(text)[0] if not blank(r)], text


def big_file(n=3000):
    """Quoted cells over many lines, whole records of quotes, blank lines, stray quotes."""
    pick = random.Random(8)
    out = []
    for i in range(n):
        name = pick.choice([
            "plain", '5" pipe', '"two\nlines"', '"a ""b"",\n\nc"', '" "', '"x\r\ny"', '"long\n' + "z\n" * 40 + '"',
        ])
        out.append(f"S{i},X{i},B{i},{name},NEW,{i},1" + pick.choice(["\n", "\r\n", "\n\n", "\n  \n", "\r"]))
    return REC_HEAD + "\n" + "".join(out)


def test_a_file_is_cut_by_many_tasks(spark, tmp_path):
    content = big_file()
    write_folder(tmp_path, "a", {"x_rec.csv": content, "y_rec.csv": content.replace("S", "T")})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = file_lines(spark, f"{tmp_path}/*/*", "ISO-8859-1")
        states = block_states(lines)
        assert states.count() > 40
        assert 0 < states.where("state = 1").count() < states.count()
        got = cut_records(lines, states).where("path like '%x_rec%'").orderBy("number").collect()
        want = [r for r in machine(content)[0] if not blank(r)]
        assert [r.number for r in got] == list(range(1, len(want) + 1))
        assert [machine(r.record)[0][0] for r in got] == want
        read = read_report(spark, f"{tmp_path}/*/*", "rec")
        assert read.rdd.getNumPartitions() > 1
        names = dict(read.where("sku like 'S%'").select("sku", "product_name").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert names == {r[0]: r[3] if r[3].strip() else r[3] for r in want[1:]}


HUGE = "ab, \n" * 200_000
ODD = (
    REC_HEAD.replace("condition", 'the"condition') + ",note\n"
    'S1,X1,B1,5" pipe,NEW,1,2,first\n'
    'S2,X2,B2,"a, ""b""",NEW,1,2,last 6"\n'
    f'S3,X3,B3,"{HUGE}"\n'
    'S4,X4,B4,name,NEW,1,2,3" a, 4" b\n'
    f'S5,X5,B5,"{HUGE}",NEW,1,2,3,4\n'
    'S6,X6,B6,"closed"tail,NEW,abc,12.5,n\n'
    'S7,X7,B7, "no, quote",NEW,1,2\n'
    'S8,X8,B8,"",NEW,nan,7.0,n\n'
)
WANT = [
    ("X1", '5" pipe', 1, 2, "first"), ("X2", 'a, "b"', 1, 2, 'last 6"'),
    ("X3", HUGE, None, None, None), ("X6", "closedtail", None, None, "n"),
    ("X8", None, None, 7, "n"),
]
SHOWN = ["fnsku", "product_name", "discrepant_quantity", "quantity", "note"]
# S4 and S5 have nine cells under eight names; S7 has nine since its quote is text.
LOST = [("adj", 0, 0, 0), ("rec", 8, 3, 2), ("rei", 0, 0, 0)]


def complete(rec):
    return {"x_rec.csv": rec, "x_adj.csv": ADJ_HEAD + "\n", "x_rei.csv": REI_HEAD + "\n"}


def test_odd_quotes_in_folders(spark, tmp_path):
    odd = ODD.replace(' "no, quote",NEW,1,2\n', ' "no, quote",NEW,1,2,n\n')
    write_folder(tmp_path, "a", complete(odd))
    write_folder(tmp_path, "b", complete(REC_HEAD + '\nS1,X1,B1,2" in,NEW,1,x\n'))
    write_folder(tmp_path, "c", {"x_rec.csv": REC_HEAD})
    found = read_packages(spark, str(tmp_path))
    assert rows(found["rec"].where("client = 'a'"), *SHOWN) == sorted(WANT, key=repr)
    assert rows(found["rec"].where("client = 'b'"), "fnsku", "product_name", "quantity") == [
        ("X1", '2" in', None),
    ]
    lost = found["losses"].where("rows > 0")
    assert rows(lost, "client", "kind", "rows", "skipped_rows", "unparsed_cells") == [
        ("a", "rec", 8, 3, 2), ("b", "rec", 1, 0, 1),
    ]
    assert rows(found["status"], "client", "status", "skipped_rows", "unparsed_cells") == [
        ("a", "ok", 3, 2), ("b", "ok", 0, 1), ("c", "no file for adj", 0, 0),
    ]


def test_odd_quotes_in_archives(spark):
    odd = ODD.replace(' "no, quote",NEW,1,2\n', ' "no, quote",NEW,1,2,n\n')
    frame = spark.createDataFrame(
        [("c", "c.zip", bytearray(zipped(complete(odd))))],
        "client string, archive string, content binary",
    )
    contents = archive_contents(frame)
    assert members_of(contents).count() == 3
    lines = lines_of(contents)
    assert rows(reports_from_lines(lines)["rec"], *SHOWN) == sorted(WANT, key=repr)
    assert rows(losses_from_lines(lines), "kind", "rows", "skipped_rows", "unparsed_cells") == [
        ("rec", 8, 3, 2),
    ]


@pytest.mark.parametrize("multi_line", [True, False])
def test_stray_opening_quote_in_a_plain_file(spark, tmp_path, multi_line):
    """A quote that nothing closes takes the rest of the file, unless lines are rows."""
    content = REC_HEAD + "\nS1,X1,B1,a,NEW,1,2\nS2,X2,B2,\"open,NEW,1,2\nS3,X3,B3,c,NEW,1,2\n"
    write_folder(tmp_path, "a", {"x_rec.csv": content})
    got = rows(read_report(spark, f"{tmp_path}/*/*", "rec", multi_line=multi_line), "fnsku")
    assert got == ([("X1",), ("X2",)] if multi_line else [("X1",), ("X2",), ("X3",)])
