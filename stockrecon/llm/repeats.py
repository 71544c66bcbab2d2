"""Repeated byte strings across documents, by sparse distributed prefix doubling.

A position's rank at length h stands for its next h bytes, and the pair of ranks at
p and p + h gives the rank at 2 h. Ranks are content names, so that tasks agree on
them without a shared table. The lengths 1 to 16 are doubled inside the map tasks. Of
each window of ``length`` bytes only the least 16-byte name is sent on: windows that
are equal have the same one, and neighbouring windows share it, about one in 18
bytes. Spark sorts these, and names found in one document only are dropped with all
their windows. The positions left are sorted once more, now with the bytes their
windows span, and their ranks doubled up to ``length``. Equal final ranks are
verified on the bytes, so a clash of names cannot remove anything.

Names held by very many documents take another way to the same answer: their
distinct spans, then their distinct windows, are groupings with a map-side combine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf
from stockrecon.sources.shipping import ship_package

LENGTH = 50
#: Bytes of the first ranks that Spark sorts.
FIRST = 16
#: Bytes, and windows, that a task works on at once.
PORTION = 1 << 18
CHUNK = 1 << 18
#: Rows whose texts a task holds at once.
ROWS = 512
#: Documents of one name above which its windows are grouped by Spark, not in one task.
HOT = 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x94D049BB133111EB)


def ranks(data: np.ndarray, length: int, known: np.ndarray | None = None, have: int = 1):
    """64-bit names of all strings of ``length`` bytes, from names of ``have`` bytes."""
    names = (data.astype(np.uint64) + np.uint64(1)) * _A if known is None else known
    while have < length:
        step = min(have, length - have)
        ahead = names[step:]
        names = names[: len(ahead)] * _B + (ahead ^ (ahead >> np.uint64(29))) * _A
        names ^= names >> np.uint64(31)
        have += step
    return names


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` neighbours."""
    have = 1
    while have < span:
        step = min(have, span - have)
        values = np.minimum(values[: len(values) - step], values[step:])
        have += step
    return values


def _slices(batches, rows: int = ROWS):
    """Batches cut to so few rows that their texts, as a list, stay small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _portions(texts, length: int, size: int = PORTION):
    """Lists of (text number, place, bytes); each window of a text starts in one of them."""
    held, weight = [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, size):
            part = text[at : at + size + length - 1]
            held.append((k, at, part))
            weight += len(part)
            if weight >= size:
                yield held
                held, weight = [], 0
    if held:
        yield held


def _runs(portion: list, length: int):
    """Neighbouring windows with one least name: names, parts, first windows, how many."""
    first = min(FIRST, length)
    span = length - first + 1
    sizes = np.array([len(part) for _, _, part in portion])
    joined = b"".join(part for _, _, part in portion)
    least = _least(ranks(np.frombuffer(joined, np.uint8), first), span)
    part = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= np.cumsum(sizes)[part])
    names, part = least[at], part[at]
    new = np.ones(len(at), bool)
    new[1:] = (names[1:] != names[:-1]) | (part[1:] != part[:-1])
    begin = np.flatnonzero(new)
    cuts = -(-np.diff(np.append(begin, len(at))) // span)  # periodic texts have long runs
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(begin, cuts) + span * nth
    return joined, names[begin].view(np.int64), part[begin], at[begin], np.diff(
        np.append(begin, len(at))
    )


def _first_ranks(length: int):
    """Map side: ``name, doc``, each name of a portion once for a document."""

    def run(batches):
        for batch in _slices(batches):
            docs = batch.column(0).to_numpy()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for portion in _portions([t or b"" for t in texts], length):
                _, names, part, _, _ = _runs(portion, length)
                row = np.array([k for k, _, _ in portion])[part]
                order = np.lexsort((names, row))
                names, row = names[order], row[order]
                new = np.ones(len(names), bool)
                new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[new]), pa.array(docs[row[new]])], names=["name", "doc"]
                )

    return run


def _shared_only(batches):
    """Rows sorted by name and document: those whose name is in several documents.

    Also counts the rows of a name. Nothing of a name is kept but its last state.
    """
    name_before, doc_before, seen, shared = None, None, 0, False
    for batch in batches:
        names, docs = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(names):
            continue
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(names)))
        several = docs[begin] != docs[begin + sizes - 1]
        before = np.zeros(len(begin), np.int64)
        extra = None
        if names[0] == name_before:
            before[0] = seen
            if shared or docs[sizes[0] - 1] != doc_before:
                several[0] = True
                if not shared:
                    extra = (name_before, doc_before)
        keep = np.repeat(several, sizes)
        nth = np.arange(len(names)) - np.repeat(begin - before, sizes)
        out = [names[keep], docs[keep], nth[keep]]
        if extra:
            out = [np.append(o, x).astype(np.int64) for o, x in zip(out, (*extra, 0))]
        name_before, doc_before = names[-1], docs[-1]
        seen, shared = int(nth[-1]) + 1, bool(several[-1])
        yield pa.RecordBatch.from_arrays([pa.array(o) for o in out], names=["name", "doc", "nth"])


_SPANS = pa.schema(
    [("name", pa.int64()), ("doc", pa.int64()), ("which", pa.int64()), ("start", pa.int64()),
     ("body", pa.binary())]
)


def _spans_of(length: int):
    """The bytes around every position that is left: ``name, doc, which, start, body``."""

    def known(lists) -> tuple[np.ndarray, np.ndarray]:
        """Names mixed with the number of their row, and where each row's begin."""
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        row = np.repeat(np.arange(len(lists)), sizes)
        names = lists.flatten().to_numpy().view(np.uint64) ^ (row.astype(np.uint64) * _B)
        return names, np.concatenate(([0], np.cumsum(sizes)))

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in _slices(batches):
            docs, which = (batch.column(i).to_numpy() for i in (0, 1))
            left, begin = known(batch.column(3))
            texts = [unzip.decompress(b) for b in batch.column(2).to_pylist()]
            for portion in _portions(texts, length):
                joined, names, part, at, many = _runs(portion, length)
                row = np.array([k for k, _, _ in portion])[part]
                key = names.view(np.uint64) ^ (row.astype(np.uint64) * _B)
                mine = left[begin[portion[0][0]] : begin[portion[-1][0] + 1]]
                some = np.flatnonzero(np.isin(key, mine))
                origin = np.array([place for _, place, _ in portion])
                sizes = np.array([len(p) for _, _, p in portion])
                start = at - (np.cumsum(sizes) - sizes)[part] + origin[part]
                ends = (at + many + length - 1)[some].tolist()
                bodies = [joined[i:j] for i, j in zip(at[some].tolist(), ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[some]), pa.array(docs[row[some]]),
                     pa.array(which[row[some]]), pa.array(start[some]),
                     pa.array(bodies, pa.binary())],
                    schema=_SPANS,
                )

    return run


def _groups(places: np.ndarray, joined: np.ndarray, length: int) -> np.ndarray:
    """Class of every window that begins at ``places``: equal for equal bytes only."""
    names = ranks(joined, length)[places]
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    rows = np.lib.stride_tricks.sliding_window_view(joined, length)
    for lo in range(0, len(same), CHUNK):
        at = order[lo : lo + CHUNK + 1]
        windows = rows[places[at]]
        equal = (windows[1:] == windows[:-1]).all(axis=1)
        if (same[lo : lo + CHUNK] & ~equal).any():  # a clash of names: compare bytes alone
            whole = np.ascontiguousarray(rows[places]).view(np.dtype((np.void, length))).ravel()
            return np.unique(whole, return_inverse=True)[1]
    group = np.empty(len(names), np.int64)
    group[order] = np.cumsum(np.concatenate(([True], ~same))) - 1
    return group


def covered(docs: np.ndarray, bodies: list[bytes], length: int = LENGTH):
    """Windows of ``bodies`` that a smaller document holds: body number, first, last of runs."""
    sizes = np.array([len(b) for b in bodies])
    joined = np.frombuffer(b"".join(bodies), np.uint8)
    many = sizes - length + 1
    body = np.repeat(np.arange(len(bodies)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    group = _groups((np.cumsum(sizes) - sizes)[body] + nth, joined, length)
    least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, docs[body])
    hit = np.flatnonzero(least[group] < docs[body])
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (body[hit[1:]] != body[hit[:-1]])
    first = hit[new]
    last = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else first
    return body[first], nth[first], nth[last]


def _resolve(length: int):
    """Spans sorted by name: ``doc, which, first, past`` of what smaller documents hold."""

    def answer(table: pa.Table):
        docs, which, start = (
            table.column(c).to_numpy() for c in ("doc", "which", "start")
        )
        body, first, last = covered(docs, table.column("body").to_pylist(), length)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[body]), pa.array(which[body]), pa.array(start[body] + first),
             pa.array(start[body] + last + length)],
            names=["doc", "which", "first", "past"],
        )

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows * length < CHUNK:
                continue
            table = pa.Table.from_batches(held)
            names = table.column("name").to_numpy()
            # The last name may go on in the next batch.
            whole = int(np.searchsorted(names == names[-1], True))
            if whole:
                yield answer(table.slice(0, whole))
            held, rows = table.slice(whole).to_batches(), rows - whole
        if rows:
            yield answer(pa.Table.from_batches(held))

    return run


def _hot_cover(spans: DataFrame, length: int) -> DataFrame:
    """As ``_resolve``, by groupings of the distinct spans and of their distinct windows."""
    distinct = spans.groupBy("name", "body").agg(F.min("doc").alias("least"))
    windows = distinct.select(
        "name", "body", "least",
        F.explode(F.sequence(F.lit(0), F.length("body") - length)).alias("nth"),
    ).withColumn("window", F.expr(f"substring(body, nth + 1, {length})"))
    minima = windows.groupBy("window").agg(F.min("least").alias("holder"))
    lists = (
        windows.join(minima, "window").groupBy("name", "body")
        .agg(F.collect_list(F.struct("nth", "holder")).alias("holders"))
    )
    # Both sides come straight from their shuffle: Spark splits the copies of a span.
    return (
        spans.join(lists, ["name", "body"])
        .select("doc", "which", "start", F.explode("holders").alias("w"))
        .where("w.holder < doc")
        .select(
            "doc", "which", (F.col("start") + F.col("w.nth")).alias("first"),
            (F.col("start") + F.col("w.nth") + length).alias("past"),
        )
    )


def _zipped(batches):
    pack = zstandard.ZstdCompressor(level=1, write_content_size=True)
    for batch in _slices(batches):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array([pack.compress(t or b"") for t in texts], pa.binary())],
            names=["doc", "which", "body"],
        )


def merged(first: np.ndarray, past: np.ndarray) -> list[tuple[int, int]]:
    """Union of the intervals; those that touch become one."""
    out: list[list[int]] = []
    order = np.argsort(first, kind="stable")
    for i, j in zip(first[order].tolist(), past[order].tolist()):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return [(i, j) for i, j in out]


_OUT = "doc_id long, n_bytes long, spans array<struct<first: long, past: long>>, kept binary"
_SPAN_LIST = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


def _cut(batches):
    unzip = zstandard.ZstdDecompressor()
    for batch in _slices(batches):
        which = batch.column(1).to_pylist()
        lists = batch.column(3)
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        inner = lists.flatten()
        of, first, past = (
            np.asarray(inner.field(i).to_numpy(zero_copy_only=False), np.int64) for i in range(3)
        )
        ends = np.cumsum(sizes)
        n_bytes, spans, kept = [], [], []
        for k, body in enumerate(batch.column(2).to_pylist()):
            text = unzip.decompress(body)
            mine = slice(ends[k] - sizes[k], ends[k])
            own = of[mine] == which[k]
            gone = merged(first[mine][own], past[mine][own])
            edges = [0, *(x for span in gone for x in span), len(text)]
            n_bytes.append(len(text))
            spans.append([{"first": i, "past": j} for i, j in gone])
            kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(spans, _SPAN_LIST),
             pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept``.

    ``kept`` has the bytes of the text (UTF-8, null as empty) without those covered by
    a string of ``length`` bytes that also starts in a document with a smaller id;
    ``spans`` are the maximal removed runs, ``past`` exclusive. Strings are judged on
    the input and never cross documents. Repeated rows keep a row each and count as
    one document. Rows without an id lose nothing and take nothing from others.
    Other columns are not read; an empty table gives an empty result. Names in more than ``hot`` documents are resolved by groupings; the
    result does not depend on it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shelf = Shelf(spark)
    source = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")
    )
    named = source.where("doc is not null")
    repeated = named.groupBy("doc").count().where("count > 1").limit(1).count()
    # Tells rows of one id apart, where there are any.
    which = F.xxhash64("text") if repeated else F.lit(0).cast("long")

    left = shelf.put(
        named.mapInArrow(_first_ranks(length), "name long, doc long")
        .repartition("name").sortWithinPartitions("name", "doc")
        .mapInArrow(_shared_only, "name long, doc long, nth long")
    )
    crowded = left.where(F.col("nth") == hot).select("name").distinct()
    any_hot = crowded.limit(1).count() > 0
    marked = left.withColumn("hot", F.lit(False))
    if any_hot:
        crowded = shelf.put(crowded.withColumn("hot", F.lit(True)))
        marked = left.join(crowded, "name", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lists = marked.groupBy("doc").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("name"))).alias("names"),
        F.collect_set(F.when(F.col("hot"), F.col("name"))).alias("hot_names"),
    )

    zipped = source.select("doc", which.alias("which"), "text").mapInArrow(
        _zipped, "doc long, which long, body binary"
    )
    # One shuffle of the texts: all joins below read it.
    texts = zipped.where("doc is not null").repartition("doc")

    def spans(names: str) -> DataFrame:
        own = lists.where(F.size(names) > 0).select("doc", names)
        return texts.join(own, "doc").select("doc", "which", "body", names).mapInArrow(
            _spans_of(length), "name long, doc long, which long, start long, body binary"
        )

    found = (
        spans("names").repartition("name").sortWithinPartitions("name")
        .mapInArrow(_resolve(length), "doc long, which long, first long, past long")
    )
    if any_hot:
        found = found.unionByName(_hot_cover(spans("hot_names"), length))
    gone = found.groupBy("doc").agg(F.collect_list(F.struct("which", "first", "past")).alias("gone"))
    without_id = zipped.where("doc is null").select(
        "doc", "which", "body", F.lit(None).cast(gone.schema["gone"].dataType).alias("gone")
    )
    return (
        texts.join(gone, "doc", "left").select("doc", "which", "body", "gone")
        .unionByName(without_id).mapInArrow(_cut, _OUT)
    )
