"""CSV text cut into records and cells by an automaton over quotes.

A quote opens a quoted cell only at the start of a cell; anywhere else it is text.
Inside, two quotes in a row are one quote of text, and separators and line breaks
are text. At a line break only one thing matters to what follows: whether a quoted
cell is open. So a line is a function of that one bit. Functions of lines compose to
the function of a block of a file, those of blocks to the state in which each block
begins, and with it every block is cut by itself. A large file is thus read by many
tasks even where its cells hold line breaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockrecon.sources.shipping import ship_package

# One quoted stretch that begins at the start of a cell or right after another one.
_STRETCH = r'(?:(?<![^,])|\G)"[^"]*"'
# A cell behind its separator: quoted stretches, then plain text. Possessive: no way back.
_CELL = r',((?:"[^"]*+(?:"|\z))*+[^,]*+)'
_QUOTED = r'^((?:"[^"]*+(?:"|\z))*+)'
_LINE_END = r"(?:\r\n|\r|\n)\z"
_RETURN = re.compile(r"(?<=\r)(?!\n)")
FACTS = (
    "path string, block long, end0 long, end1 long, starts0 long, starts1 long, broken boolean,"
    " first_line string, header string"
)


def leaves_open(text: Column) -> Column:
    """Whether ``text``, begun outside of quotes, ends inside a quoted cell."""
    return F.regexp_replace(text, _STRETCH, "").rlike('(^|,)"')


def cells_of(record: Column) -> Column:
    """Cells of a record as written, quotes included; at least one."""
    return F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1))


def cell_text(cell: Column) -> Column:
    """What a cell says: without its quotes, doubled ones as one."""
    quote, doubled = F.lit('"'), F.lit('""')
    inner = F.substr(cell, F.lit(2), F.length(cell) - 2)
    # One quoted stretch with nothing behind it: all quotes inside are doubled.
    usual = (
        (F.length(cell) > 1) & F.endswith(cell, quote)
        & ~F.contains(F.replace(inner, doubled, F.lit("")), quote)
    )
    return (
        F.when(~F.startswith(cell, quote), cell).when(usual, F.replace(inner, doubled, quote))
        .otherwise(_odd_text(cell))
    )


def cell_texts(record: Column) -> Column:
    """What the cells of a record say; a record without quotes is cut at its separators."""
    return F.when(
        F.contains(record, F.lit('"')), F.transform(cells_of(record), cell_text)
    ).otherwise(F.split(record, ",", -1))


def _odd_text(cell: Column) -> Column:
    """Text of a cell with plain text behind quoted stretches, or with an open one."""
    quoted = F.regexp_extract(cell, _QUOTED, 1)
    closed = (F.length(quoted) - F.length(F.replace(quoted, F.lit('"'), F.lit("")))) % 2 == 0
    inner = F.substr(quoted, F.lit(2), F.length(quoted) - F.when(closed, 2).otherwise(1))
    plain = F.substr(cell, F.length(quoted) + 1)
    return F.concat(F.replace(inner, F.lit('""'), F.lit('"')), plain)


def still_open(line: str, inside: bool) -> bool:
    """``leaves_open`` for one line in Python, from either state."""
    at = 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at) + 1
            if not at:
                return True
            if line.startswith('"', at):
                at += 1
                continue
            inside = False
        at = line.find(',"', at) + 2
        if at < 2:
            return False
        inside = True


def _joined(lines: list[str]) -> str:
    return "".join(lines).removesuffix("\n").removesuffix("\r")


def records_of(lines: Iterator[str]) -> Iterator[str]:
    """Records without blank ones, from lines with their ends."""
    held: list[str] = []
    inside = False
    for line in lines:
        if not held and not line.strip():
            continue
        inside = still_open(line, inside)
        held.append(line)
        if not inside:
            yield _joined(held)
            held = []
    if held:
        yield _joined(held)


def file_lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """``path, file_name, block, line``: text up to each line feed, with it.

    A block is the part of a file that one task reads. Its rows come in the order of the
    file, which holds as long as they are not shuffled.
    """
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat(F.decode(F.col("value").cast("binary"), encoding), F.lit("\n")).alias("line"),
    )


def _is_blank(line: str) -> bool:
    return not line.strip(" \t\n\x0b\f\r")


def _pieces(line: str) -> list[str]:
    """Lines of a row: a carriage return alone ends a line too."""
    return _RETURN.split(line) if "\r" in line else [line]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[str]]]:
    """Lines of each block in a batch, under the values of the block's other columns."""
    lines = batch.column("line")
    named = [c for c in batch.schema.names if c != "line"]
    ends = {batch.num_rows}
    for name in ("path", "block"):
        ends.update(pc.run_end_encode(batch.column(name)).run_ends.to_pylist())
    at = 0
    for end in sorted(ends - {0}):
        yield tuple(batch.column(c)[at].as_py() for c in named), lines[at:end].to_numpy(zero_copy_only=False).tolist()
        at = end


class _Facts:
    """What a block does to the open bit, from either state, and what begins in it."""

    def __init__(self):
        self.states, self.starts, self.broken = [False, True], [0, 0], False
        self.record: list[str] = []
        self.first_line: str | None = None
        self.header: str | None = None

    def add(self, line: str, keep_first: bool) -> None:
        filled = not _is_blank(line)
        for i in (0, 1):
            self.starts[i] += filled and not self.states[i]
        keeps = keep_first and self.header is None and self.starts[0] > 0
        if keeps:
            self.first_line = self.first_line or _joined([line])
            self.record.append(line)
        if '"' in line:
            before = self.states
            after = still_open(line, before[0])
            self.states = [after, after if before[0] == before[1] else still_open(line, before[1])]
        self.broken |= self.states[0]
        if keeps and not self.states[0]:
            self.header, self.record = _joined(self.record), []


def block_facts(lines: DataFrame) -> DataFrame:
    """One row per block of ``file_lines``, found where the block is read.

    ``end0`` and ``end1``: the state after the block, by the state before it; ``starts0``
    and ``starts1``: records that begin in it; ``broken``: whether some line leaves a cell
    open. The block at the start of a file has the ``first_line`` that is not blank, and its
    first record as ``header``, if that ends in the block.
    """
    ship_package(lines.sparkSession)

    def reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, facts = None, _Facts()

        def found() -> pa.RecordBatch:
            row = (
                *key, *map(int, facts.states), *facts.starts, facts.broken,
                facts.first_line, facts.header,
            )
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for batch in batches:
            for run, texts in _runs(batch):
                if run != key:
                    if key is not None:
                        yield found()
                    key, facts = run, _Facts()
                for text in texts:
                    for line in _pieces(text):
                        facts.add(line, key[1] == 0)
        if key is not None:
            yield found()

    number, text = pa.int64(), pa.string()
    types = [text, *[number] * 5, pa.bool_(), text, text]
    names = [field.split()[0] for field in FACTS.split(", ")]
    return lines.select("path", "block", "line").mapInArrow(reading, FACTS)


def _composed(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Add ``after0`` and ``after1``: the state after a row, by the state before the first.

    Rows have ``end0`` and ``end1``, their own function. Since its last constant row, a
    state has only been turned or left alone.
    """
    so_far = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    constant = F.col("end0") == F.col("end1")
    turns = F.sum(F.when(~constant & (F.col("end0") == 1), 1).otherwise(0)).over(so_far) % 2
    turned = df.withColumn("turned", turns.cast("long"))
    known = F.when(constant, F.col("end0").bitwiseXOR(F.col("turned")))
    known = turned.withColumn("known", F.last(known, ignorenulls=True).over(so_far))
    return known.select(
        *df.columns,
        *[F.coalesce("known", F.lit(s).cast("long")).bitwiseXOR(F.col("turned")).alias(f"after{s}")
          for s in (0, 1)],
    )


def _with_before(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    row = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns(
        {f"before{s}": F.coalesce(F.lag(f"after{s}").over(row), F.lit(s)) for s in (0, 1)}
    )


def linked_states(facts: DataFrame) -> DataFrame:
    """For each block the state it begins in, and how many records begin before it.

    From ``block_facts``. One row per block; a file has one block per split.
    """
    linked = _with_before(_composed(facts, ["path"], ["block"]), ["path"], ["block"])
    starts = F.when(F.col("before0") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return linked.withColumn("starts", starts).select(
        "path", "block", F.col("before0").alias("state"),
        F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("offset"),
        F.col("after0").alias("after"),
    )


def block_states(lines: DataFrame) -> DataFrame:
    return linked_states(block_facts(lines))


def _whole(path: str, records: list[tuple[int, int, bool, str]]) -> pa.RecordBatch:
    columns = list(zip(*records))
    types = (pa.int64(), pa.int64(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(path, pa.string()), len(records)), *map(pa.array, columns, types)],
        ["path", "number", "block", "whole", "record"],
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one block, and the parts of those that do not."""
    key, out = None, []
    inside, held, number, whole = False, [], 0, True
    for batch in batches:
        for (path, block, state, offset), texts in _runs(batch):
            if (path, block) != key:
                if held:
                    yield _whole(key[0], [(number, key[1], False, "".join(held))])
                key = path, block
                inside, held, number = state == 1, [], offset
                whole = not inside
            for text in texts:
                for line in _pieces(text):
                    if not inside and not held:
                        if _is_blank(line):
                            continue
                        number += 1
                        whole = True
                    held.append(line)
                    inside = still_open(line, inside) if '"' in line else inside
                    if not inside:
                        out.append((number, block, whole, _joined(held) if whole else "".join(held)))
                        held = []
            if out:
                yield _whole(path, out)
                out = []
    if held:
        yield _whole(key[0], [(number, key[1], False, "".join(held))])


def cut_records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``path, number, record`` from ``file_lines`` and their ``block_states``.

    Records are numbered from 1 within a file; blank lines between them are left out.
    Records stay in the task that reads their block; only the parts of those that go on in
    the next block are put together. States are broadcast, one row per block behind the
    first of a file, so that lines stay in order.
    """
    ship_package(lines.sparkSession)
    rows = "path string, number long, block long, whole boolean, record string"

    def cut(part: DataFrame) -> DataFrame:
        known = part.join(F.broadcast(states.where("block > 0")), ["path", "block"], "left")
        return known.select(
            "path", "block", F.coalesce("state", F.lit(0)).alias("state"),
            F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), "line",
        ).mapInArrow(_cut, rows)

    # Only blocks that begin or end inside a record are read again for the parts.
    crossed = F.broadcast(states.where("state = 1 or after = 1").select("path", "block"))
    crossing = cut(lines.join(crossed, ["path", "block"], "left_semi"))
    one = cut(lines).where("whole").select("path", "number", "record")
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    several = crossing.where("not whole").groupBy("path", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "").alias("record")
    )
    return one.unionByName(
        several.withColumn("record", F.regexp_replace("record", _LINE_END, ""))
    )
