"""Bloom filter of keys, which keeps rows without a partner out of a shuffle.

Keys turn into bits of 64-bit words, four bits of one word each. The words that hold
any bit are broadcast: at most ``words`` rows of two numbers, however many keys there
are. A row passes if its word has all four bits of its key, so no row with a partner
is lost; a row without one passes by chance, the more often the fuller the words are.
The join behind the filter decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the broadcast side at most, about 100 MB. Up to four keys a word, one row in
#: forty passes by chance; at sixteen, four in ten do.
WORDS = 1 << 21
_PROBES = 4


def _word(hashed: Column, words: int) -> Column:
    return F.pmod(hashed, F.lit(words).cast("long"))


def _bits(hashed: Column) -> Column:
    """The bits of a key within its word, from the upper 24 bits of its hash."""
    one = F.lit(1).cast("long")
    places = [
        F.shiftrightunsigned(hashed, 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        for i in range(_PROBES)
    ]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def key_words(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """``word, bits`` of all rows without nulls; partial words combine before the shuffle."""
    hashed = F.xxhash64(*[f"`{c}`" for c in keys.columns])
    marked = keys.dropna().select(_word(hashed, words).alias("word"), _bits(hashed).alias("mask"))
    return marked.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def may_match(df: DataFrame, other: DataFrame, keys: list[str], words: int = WORDS) -> DataFrame:
    """Rows of ``df`` whose keys may occur in ``other``: all that do, few that do not.

    Rows with a null key match nothing and are left out. ``other`` is read once more,
    so it should be stored. Keys of different types have different hashes; then every
    row passes.
    """
    if any(df.schema[k].dataType != other.schema[k].dataType for k in keys):
        return df
    found = F.broadcast(key_words(other.select(*keys), words).toDF("_at", "_bits"))
    # Columns of their own: a join would hash the keys again for every use of its condition.
    hashed = df.dropna(subset=keys).withColumn("_hash", F.xxhash64(*[f"`{k}`" for k in keys]))
    known = hashed.withColumns({"_word": _word(F.col("_hash"), words), "_mask": _bits(F.col("_hash"))})
    fits = F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    passed = known.join(found, (F.col("_word") == F.col("_at")) & fits, "left_semi")
    return passed.select(*[f"`{c}`" for c in df.columns])
