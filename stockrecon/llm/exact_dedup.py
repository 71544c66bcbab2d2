"""Exact duplicates by Patricia-trie owners.

Every distinct text has one owner task, found by its length and content hash.
The owner inserts whole byte strings into a compressed radix trie, so texts are
equal only if all their bytes are. Map tasks collapse their own copies in such
a trie first: a text with any number of copies reaches its owner once per map
task, and the copies themselves never travel.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.shipping import ship_package

#: Bytes of text and nodes that one trie keeps before it spills or flushes.
TRIE_BYTES = 128 << 20
_NODE_BYTES = 400
_HEAD = struct.Struct("<qq?q")


def _shared(key: bytes, start: int, edge: bytes) -> int:
    """Length of the common prefix of ``key[start:]`` and ``edge``."""
    low, high = 0, min(len(key) - start, len(edge))
    while low < high:
        middle = (low + high + 1) // 2
        if key[start + low : start + middle] == edge[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _Node:
    __slots__ = ("children", "edge", "end")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, _Node | _Spilled] = {}
        self.end: list | None = None


class _Spilled:
    """A subtree that lies in a file of the task."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def add(self, key: bytes, best: int | None, count: int) -> None:
        self.file.write(_HEAD.pack(len(key), best or 0, best is None, count))
        self.file.write(key)

    def records(self) -> Iterator[tuple[bytes, int | None, int]]:
        self.file.seek(0)
        while head := self.file.read(_HEAD.size):
            size, best, missing, count = _HEAD.unpack(head)
            yield self.file.read(size), None if missing else best, count
        self.file.close()


class Trie:
    """Compressed radix trie; a terminal holds the id that stays and the number of copies.

    Beyond ``limit`` bytes the largest subtree below the first branch moves to a
    file, and later keys of that subtree follow it there. ``items`` gives what is
    in memory, then works off one spilled subtree after the other in the same way:
    its keys share a longer prefix, so the subtrees get smaller each time.
    """

    def __init__(self, choose=max, limit: int = TRIE_BYTES):
        self.choose = choose
        self.limit = limit
        self.root = _Node(b"")
        self.held = 0
        self.spilled: list[_Spilled] = []

    def insert(self, key: bytes, best: int | None, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.held += len(key) - at + _NODE_BYTES
            elif isinstance(child, _Spilled):
                child.add(key, best, count)
                return
            elif not key.startswith(child.edge, at):
                child = self._split(node, child, _shared(key, at, child.edge))
            at += len(child.edge)
            node = child
        if node.end is None:
            node.end = [best, count]
        else:
            node.end[0] = self._better(node.end[0], best)
            node.end[1] += count
        if self.held > self.limit:
            self._spill()

    def _better(self, a: int | None, b: int | None) -> int | None:
        if a is None or b is None:
            return b if a is None else a
        return self.choose(a, b)

    def _split(self, parent: _Node, child: _Node, size: int) -> _Node:
        middle = _Node(child.edge[:size])
        child.edge = child.edge[size:]
        middle.children[child.edge[0]] = child
        parent.children[middle.edge[0]] = middle
        self.held += _NODE_BYTES
        return middle

    @staticmethod
    def _walk(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, _Node]]:
        todo = [(prefix, node)]
        while todo:
            above, node = todo.pop()
            key = above + node.edge
            yield key, node
            todo.extend((key, c) for c in node.children.values() if isinstance(c, _Node))

    def _spill(self) -> None:
        node, prefix = self.root, b""
        while node.end is None and len(node.children) == 1:
            (child,) = node.children.values()
            if isinstance(child, _Spilled):
                return
            node, prefix = child, prefix + child.edge
        sizes = {
            first: sum(len(n.edge) + _NODE_BYTES for _, n in self._walk(child, b""))
            for first, child in node.children.items()
            if isinstance(child, _Node)
        }
        if not sizes:
            return
        first = max(sizes, key=sizes.get)
        target = _Spilled()
        for key, inner in self._walk(node.children[first], prefix):
            if inner.end is not None:
                target.add(key, *inner.end)
            for other in inner.children.values():
                if isinstance(other, _Spilled):
                    for record in other.records():
                        target.add(*record)
                    self.spilled.remove(other)
        node.children[first] = target
        self.spilled.append(target)
        self.held -= sizes[first]

    def items(self) -> Iterator[tuple[bytes, int | None, int]]:
        for key, node in self._walk(self.root, b""):
            if node.end is not None:
                yield key, *node.end
        waiting, self.root, self.spilled = self.spilled, _Node(b""), []
        for subtree in waiting:
            deeper = Trie(self.choose, self.limit)
            for record in subtree.records():
                deeper.insert(*record)
            yield from deeper.items()


_OWNED = pa.schema(
    [("n_bytes", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
     ("best", pa.int64()), ("copies", pa.int64())]
)
_ANSWER = pa.schema(
    [("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())]
)


def _bodies(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of the normalised texts: A-Z lowered, null as empty."""
    for value in column.cast(pa.binary()):
        yield (value.as_py() or b"").lower()


def _packed(rows: Iterable[tuple], schema: pa.Schema, size: int = 32 << 20):
    """Rows as record batches of about ``size`` bytes."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if weight >= size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema
            )
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema
        )


def _collapse(choose, limit: int):
    """Map side: the copies of each text in this task become one row."""

    def owned(trie: Trie):
        for body, best, copies in trie.items():
            yield len(body), hashlib.sha256(body).digest(), body, best, copies

    def run(batches):
        trie = Trie(choose, limit)
        for batch in batches:
            for body, one in zip(_bodies(batch.column(1)), batch.column(0).to_pylist()):
                trie.insert(body, one, 1)
                if trie.spilled:  # full: hand over, and start anew
                    yield from _packed(owned(trie), _OWNED)
                    trie = Trie(choose, limit)
        yield from _packed(owned(trie), _OWNED)

    return run


def _own(choose, limit: int):
    """Owner side: all rows of one length and content hash are in this task."""

    def run(batches):
        trie = Trie(choose, limit)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            for body, best, copies in zip(*columns):
                trie.insert(body, best, copies)
        yield from _packed(
            ((hashlib.sha256(body).hexdigest(), best, n) for body, best, n in trie.items()),
            _ANSWER,
        )

    return run


def _digests(batches):
    for batch in batches:
        found = [hashlib.sha256(body).hexdigest() for body in _bodies(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.string())], names=["doc_id", "text_sha256"]
        )


def exact_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per distinct text: ``text_sha256, keep_id, group_size``.

    ``keep_id`` is the smallest (or largest) id among the copies. Texts count as
    equal if identical after lower-casing A-Z; null counts as empty. Null ids
    never win over others.
    """
    ship_package(docs.sparkSession)
    choose = {"smallest": min, "largest": max}[keep]
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    owned = source.mapInArrow(
        _collapse(choose, trie_bytes),
        "n_bytes long, digest binary, body binary, best long, copies long",
    )
    return owned.repartition("n_bytes", "digest").mapInArrow(
        _own(choose, trie_bytes), "text_sha256 string, keep_id long, group_size long"
    )


def exact_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Dropped documents have a row too. Repeated rows of one id and text count as
    copies of each other and are all marked kept if that id stays. Other columns
    of ``docs`` are not read, an empty table gives an empty result, and a group
    without any id has a null ``keep_id``.
    """
    groups = exact_groups(
        docs, id_col=id_col, text_col=text_col, keep=keep, trie_bytes=trie_bytes
    )
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    named = source.mapInArrow(_digests, "doc_id long, text_sha256 string")
    # Both sides come straight from their shuffle: Spark splits the rows of a frequent text.
    return named.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
