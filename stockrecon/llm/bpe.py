"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

No regular expression runs over the texts. Code points become classes, each
class is a transition function of a small automaton, and functions compose
associatively: a prefix scan over the transition monoid gives the state before
every code point of a whole batch at once, and with it all token boundaries. The
slices go through pair merging, whose results are cached.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.sources.shipping import ship_package

#: Code points that are scanned together.
SCAN_POINTS = 1 << 20
#: Distinct slices whose ids a worker remembers, and the longest slice it remembers.
CACHE_SLICES = 1_000_000
CACHE_CHARS = 64
#: Up to here neighbours are searched one by one, beyond with a heap.
SHORT_BYTES = 64

# The white space of the Unicode property White_Space.
_SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that form a slice with the apostrophe before them.
_SHORT_ENDINGS = ["s", "t", "m", "d"]
_LONG_ENDINGS = ["re", "ve", "ll"]

# Classes of code points in their place. APART is an apostrophe before an ending
# of one letter, APART2 of two. White space is JOIN if it is a blank right before
# something else, SOLO if it is another space there, RUN if more or nothing follows.
LETTER, NUMBER, OTHER, APART, APART2, JOIN, SOLO, RUN = range(8)
# States after a code point: what could go on. OPEN: nothing. ONE, TWO: so many
# letters of an ending are still due.
OPEN, IN_LETTERS, IN_NUMBERS, IN_OTHER, BLANK, IN_RUN, ONE, TWO = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a slice begins at this code point."""
    if kind == LETTER:
        if state in (ONE, TWO):
            return (OPEN if state == ONE else ONE), False
        return IN_LETTERS, state not in (IN_LETTERS, BLANK)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, BLANK)
    if kind in (OTHER, APART, APART2):
        if state in (IN_OTHER, BLANK):
            return IN_OTHER, False
        return {OTHER: IN_OTHER, APART: ONE, APART2: TWO}[kind], True
    if kind == RUN:
        return IN_RUN, state != IN_RUN
    return (BLANK if kind == JOIN else OPEN), True


@functools.lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers for all functions that classes compose to.

    Returns the number of each class's function (classes 8 to 15: the same at
    the start of a text, where the state before is OPEN), the composition table
    ``then[f, g]``, where each function leads from OPEN, and slice starts by
    state and class.
    """
    step = [tuple(_step(s, k)[0] for s in range(8)) for k in range(8)]
    step += [(f[OPEN],) * 8 for f in step[:8]]
    known = {f: i for i, f in enumerate(dict.fromkeys(step))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in step:
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
    functions = list(known)
    then = np.zeros((len(functions), len(functions)), np.uint8)
    for i, f in enumerate(functions):
        for j, g in enumerate(functions):
            then[i, j] = known[tuple(g[x] for x in f)]
    begins = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])
    return (
        np.array([known[f] for f in step], np.uint8),
        then,
        np.array([f[OPEN] for f in functions], np.uint8),
        begins,
    )


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or RUN of every code point."""
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    kinds[_SPACES] = RUN
    return kinds


def _scan(functions: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition: blocks side by side, then their totals, then both."""
    n = len(functions)
    length = max(1, int(np.sqrt(n)) // 4)
    columns = -(-n // length)
    identity_free = np.empty(columns * length, np.uint8)
    identity_free[:n] = functions
    identity_free[n:] = functions[-1] if n else 0
    grid = identity_free.reshape(columns, length).T.copy()
    for row in range(1, length):
        grid[row] = then[grid[row - 1], grid[row]]
    total = grid[-1].copy()
    hop = 1
    while hop < columns:
        total[hop:] = then[total[:-hop].copy(), total[hop:]]
        hop *= 2
    grid[:, 1:] = then[total[:-1][None, :], grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


def slice_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where slices begin in texts of code points laid end to end.

    ``text_starts`` are the places where (non-empty) texts begin.
    """
    of_class, then, from_open, begins = _monoid()
    kinds = _kinds()[points]
    n = len(points)
    last = np.zeros(n, bool)
    last[text_starts[1:] - 1] = True
    last[-1] = True
    following = np.empty(n, np.uint8)
    following[:-1] = kinds[1:]
    following[last] = RUN
    space = kinds == RUN
    before = space & (following != RUN)
    kinds[before] = SOLO
    kinds[before & (points == 32)] = JOIN
    marks = np.flatnonzero(points == ord("'"))
    room = np.append(text_starts[1:], n)[np.searchsorted(text_starts, marks, "right") - 1] - marks
    padded = np.append(points, np.zeros(2, points.dtype))
    one, two = padded[marks + 1], padded[marks + 2]
    short = np.isin(one, [ord(c) for c in _SHORT_ENDINGS]) & (room > 1)
    kinds[marks[short]] = APART
    for first, second in _LONG_ENDINGS:
        kinds[marks[(one == ord(first)) & (two == ord(second)) & (room > 2)]] = APART2
    functions = of_class[kinds]
    functions[text_starts] = of_class[kinds[text_starts] + 8]
    after = from_open[_scan(functions, then)]
    state = np.empty(n, np.uint8)
    state[1:] = after[:-1]
    state[text_starts] = OPEN
    return np.flatnonzero(begins[state, kinds])


def split_texts(texts: list[str]) -> Iterator[list[str]]:
    """The slices of each text, in order."""
    at = 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size + len(texts[at]) <= SCAN_POINTS):
            group.append(texts[at])
            size += len(texts[at])
            at += 1
        joined = "".join(group)
        lengths = np.fromiter(map(len, group), np.int64, len(group))
        text_starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        if not joined:
            yield from ([] for _ in group)
            continue
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        cuts = slice_starts(points, text_starts[lengths > 0])
        first = np.searchsorted(cuts, text_starts).tolist() + [len(cuts)]
        ends = np.append(cuts[1:], len(points)).tolist()
        cuts = cuts.tolist()
        for k in range(len(group)):
            yield [joined[i:j] for i, j in zip(cuts[first[k] : first[k + 1]],
                                               ends[first[k] : first[k + 1]])]


class Codec:
    """Encoder and decoder for one file of merge ranks."""

    def __init__(self, rank_file: bytes):
        pairs = map(bytes.split, rank_file.splitlines())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self._recent: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        """Merge the neighbours of least rank, leftmost first, until none has a rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > SHORT_BYTES:
            return self._merge_long(piece)
        get, none = self.ranks.get, len(self.tokens)
        cuts = list(range(len(piece) + 1))
        open_ = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while open_ and (least := min(open_)) < none:
            i = open_.index(least)
            del cuts[i + 1], open_[i]
            if i < len(open_):
                open_[i] = get(piece[cuts[i] : cuts[i + 2]], none)
            if i:
                open_[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
        return tuple([self.ranks[piece[i:j]] for i, j in zip(cuts, cuts[1:])])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap and linked neighbours: n log n in the length."""
        n = len(piece)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        size = [1] * n
        ranks = self.ranks

        def rank(i: int):
            j = after[i]
            return ranks.get(piece[i : j + size[j]]) if j < n else None

        heap = [(r, i, 1, 1) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if size[i] != left or j >= n or size[j] != right:
                continue  # one of the two has been merged since
            size[i] += size[j]
            size[j] = 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k, size[k], size[after[k]]))
        return tuple(ranks[piece[i : i + size[i]]] for i in range(n) if size[i])

    def _missing(self, text: str) -> tuple[int, ...]:
        """Ids of a slice that was not used lately."""
        found = self._older.get(text)
        if found is None:
            found = self._merge(text.encode("utf-8", "replace"))
        if len(text) <= CACHE_CHARS:
            if len(self._recent) >= CACHE_SLICES // 2:
                self._older, self._recent = self._recent, {}
            self._recent[text] = found
        return found

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        for slices in split_texts(texts):
            known = self._recent.get
            yield list(
                itertools.chain.from_iterable([known(x) or self._missing(x) for x in slices])
            )

    def ends(self, ids: list[int]) -> np.ndarray:
        """The byte at which each token ends, for decoding parts of a text."""
        return np.cumsum([len(self.tokens[i]) for i in ids], dtype=np.int64)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def listed(self, ids) -> bytes:
        """The ids in decimal, joined by blanks."""
        return " ".join(map(self.names.__getitem__, ids)).encode()


@functools.lru_cache(maxsize=2)
def _codec(rank_file: bytes) -> Codec:
    return Codec(rank_file)


def _prepared(docs: DataFrame, ranks_path: str):
    """The rank file, of fixed size, for every worker."""
    ship_package(docs.sparkSession)
    with open(ranks_path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, token ``ids`` and ``ends``, the byte at which each token ends.

    As the tiktoken library encodes ordinary text, without special tokens. Null
    counts as empty and has no ids; repeated rows keep a row each.
    """
    shared = _prepared(docs, ranks_path)

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo in range(0, len(texts), 256):
                part = list(codec.encode(texts[lo : lo + 256]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, 256),
                     pa.array(part, pa.list_(pa.int32())),
                     pa.array([codec.ends(ids) for ids in part], pa.list_(pa.int64()))],
                    names=["doc_id", "ids", "ends"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, ends array<long>"
    )


def decode(coded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and the ``text`` as bytes, from rows of ``doc_id, ids``."""
    shared = _prepared(coded, ranks_path)

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            found = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "text"]
            )

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def round_trip(
    docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode and decode in one pass."""
    shared = _prepared(docs, ranks_path)

    def run(batches):
        codec = _codec(shared.value)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for ids in codec.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                coded.append(hashlib.sha256(codec.listed(ids)).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
