"""Mixing sources to target weights by pivotal rounding, in DataFrame functions only.

Every document of a source is due ``target / source_size`` copies. The whole part
is certain; the fractional parts are rounded dependently: two documents pass
their mass on to each other, measured in words and in a random direction, until
one of them is integral. So the words of a source stay at their target until a
single document is left over. Blocks of documents are folded at the same time,
what each block leaves over meets in the next level, and the tree has as many
levels as the logarithm of the largest source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.sources.scratch import Shelf

#: Documents folded together at each level of the tree, on average.
BLOCK = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``source, source_size, target`` from one row ``source, source_size`` per source.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` times all words; a source stops at ``most`` times its own words and
    its excess goes to the others by weight until none is above. In closed form:
    ``target = min(most * size, level * weight)``, the level following from the
    sources sorted by where they stop. One row per source meets in one task.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights))
    table = sizes.select(
        "source", "source_size", turn.cast("double").alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("stop"),
    ).withColumn("ratio", F.col("stop") / F.col("weight"))
    by_stop = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    table = (
        table.withColumn("wanted", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("stopped", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn(
            "open_weight",
            F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        )
        .withColumn("level", (F.col("wanted") - F.col("stopped")) / F.col("open_weight"))
    )
    # The level falls from the first source, by where it stops, that it does not fill.
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)
    return table.select(
        "source", "source_size",
        F.least("stop", F.coalesce(level * F.col("weight"), F.col("stop"))).alias("target"),
    )


def _chance(*parts: Column) -> Column:
    """Uniform number in [0, 1), the same for the same parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(2**53))


def _fold(seed: int) -> Column:
    """Fold ``items`` (key, words, p) to what is decided and the one that is still open."""
    return F.expr(
        f"""
        aggregate(
          items,
          named_struct('done', cast(array() as array<struct<key:string,up:boolean>>),
                       'key', cast(null as string), 'words', 0D, 'p', 0D),
          (s, e) -> CASE
            WHEN s.key IS NULL
              THEN named_struct('done', s.done, 'key', e.key, 'words', e.words, 'p', e.p)
            ELSE transform(array(named_struct(
              -- words that can move from e to s, and from s to e
              'gain', least((1 - s.p) * s.words, e.p * e.words),
              'loss', least(s.p * s.words, (1 - e.p) * e.words),
              'u', shiftrightunsigned(xxhash64(s.key, e.key, {seed}L), 11)
                   / cast({2**53} as double))),
              m -> transform(array(named_struct(
                'up', m.u * (m.gain + m.loss) < m.loss,
                'moved', IF(m.u * (m.gain + m.loss) < m.loss, m.gain, -m.loss))),
                t -> transform(array(named_struct(
                  'a', s.p + t.moved / s.words, 'b', e.p - t.moved / e.words,
                  -- which of the two the move has made integral
                  'first', IF(t.up, (1 - s.p) * s.words <= e.p * e.words,
                                    s.p * s.words <= (1 - e.p) * e.words),
                  'up', t.up)),
                  r -> CASE WHEN r.first
                    THEN named_struct('done', concat(s.done, array(named_struct(
                           'key', s.key, 'up', r.up))),
                         'key', e.key, 'words', e.words, 'p', least(1D, greatest(0D, r.b)))
                    ELSE named_struct('done', concat(s.done, array(named_struct(
                           'key', e.key, 'up', NOT r.up))),
                         'key', s.key, 'words', s.words, 'p', least(1D, greatest(0D, r.a)))
                    END)[0])[0])[0]
            END)
        """
    )


def _blocks(open_: DataFrame, level: int, seed: int, block: int) -> DataFrame:
    """One row per block of a source with its items in a fixed order."""
    spread = F.pmod(F.xxhash64(F.lit(seed + level), "key"), F.col("blocks"))
    return (
        open_.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long"))
        .groupBy("source", "blocks", spread.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("key", "words", "p"))).alias("items"))
        .select("source", "blocks", _fold(seed + level).alias("s"))
    )


def round_pivotal(
    units: DataFrame, shelf: Shelf, *, seed: int = 8, block: int = BLOCK
) -> DataFrame:
    """``source, key, up`` for every unit ``source, key, words, p`` with 0 < p < 1 and words > 0.

    Within a source the expected words ``sum(p * words)`` and the words of the
    units that come out up differ by less than one unit. Keys are unique in a
    source.
    """
    counts = shelf.put(units.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    most = counts.agg(F.max("n")).collect()[0][0]
    if not most:
        return units.select("source", "key", F.lit(True).alias("up"))
    open_ = units.join(counts, units["source"].eqNullSafe(counts["source"])).select(
        units["source"], "key", "words", "p", "n"
    )
    decided, level = None, 0
    while True:
        folded = shelf.put(_blocks(open_, level, seed, block))
        part = folded.select("source", F.explode("s.done").alias("d")).select(
            "source", "d.key", "d.up"
        )
        decided = part if decided is None else decided.unionByName(part)
        open_ = folded.where("s.key is not null").select(
            "source", "s.key", "s.words", "s.p", F.col("blocks").alias("n")
        )
        if most <= 1:
            break
        most, level = math.ceil(most / block), level + 1
    last = open_.select(
        "source", "key", (_chance(F.col("key"), F.lit(seed)) < F.col("p")).alias("up")
    )
    return decided.unionByName(last)


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    most: float = 2.0, seed: int = 8,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` counts the words, ``copies`` how often the mix takes the document
    (0 to ``ceil(most)``), ``taken = copies * size``. Reruns agree: chance comes
    from hashes of the ids. Null text has size 0 and documents without words take
    the whole part of their share; null sources form a source of their own, the
    last in order. Rows that repeat id, source and size are decided together.
    """
    shelf = Shelf(docs.sparkSession)
    rows = shelf.put(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col).cast("string")).alias("size"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = shelf.put(source_targets(sizes, weights=weights, share=share, most=most))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wide = F.round(due, 9)  # a share that is whole up to rounding error is whole
    listed = targets.select(
        F.col("source").alias("s"), "source_size", "target", F.floor(wide).alias("whole"),
        (wide - F.floor(wide)).alias("p"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size")
    keyed = rows.withColumn("key", key)
    units = (
        keyed.where("size > 0").groupBy("source", "key")
        .agg(F.sum("size").cast("double").alias("words"))
    )
    units = shelf.put(
        units.join(listed.where("p > 0").select("s", "p"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "key", "words", "p"
        )
    )
    up = shelf.put(round_pivotal(units, shelf, seed=seed).where("up").select("source", "key"))
    joined = keyed.join(listed, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", "whole", "key"
    )
    up = up.select(F.col("source").alias("s"), F.col("key").alias("k"), F.lit(1).alias("one"))
    copies = (F.col("whole") + F.coalesce("one", F.lit(0))).cast("long")
    return joined.join(
        up, (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s")), "left"
    ).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def expand(
    docs: DataFrame, copies: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` decided in ``copies``."""
    decided = copies.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
        F.col("size").alias("_size"), F.col("copies").alias("_copies"),
    ).distinct()
    same = (
        F.col(id_col).cast("long").eqNullSafe(F.col("_id"))
        & F.col(source_col).cast("string").eqNullSafe(F.col("_source"))
        & (word_count(F.col(text_col).cast("string")) == F.col("_size"))
    )
    times = F.sequence(F.lit(1), F.col("_copies").cast("int"))
    return (
        docs.join(decided.where("_copies > 0"), same)
        .select(*[docs[c] for c in docs.columns], F.explode(times).alias("_n"))
        .drop("_n")
    )
