"""A Bloom filter of words as a column: tokens are tested where they are read, below every exchange.

A token that is surely not in the word list leaves before anything is shuffled. The few others that pass by chance
are dealt with by the exact semi join that follows on the counted rows, so the filter never changes a result. There is no
join on the raw tokens, hence no task that gathers the rows of a frequent word.

The filter is a scalar subquery of built-in expressions: its size follows the number of words, up to ``LARGEST`` bits; beyond
that more tokens pass, and the semi join still sorts them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_WORD, HASHES = 12, 5
#: Bits of the largest filter (8 MB).
LARGEST = 1 << 26
CELL = 64


def _places(word: Column, size: Column) -> list[Column]:
    """The ``HASHES`` bits of a word among ``size`` bits."""
    first, step = F.xxhash64(word), F.hash(word).cast("long").bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftrightunsigned(first, 1) + F.lit(i) * step, size) for i in range(HASHES)]


def word_filter(words: DataFrame, word_col: str | None = None, bits_per_word: int = BITS_PER_WORD, largest: int = LARGEST) -> Column:
    """The filter of the words in ``words`` (NULLs are no words) as one value: an array of 64-bit cells.

    Read ``words`` from a written table if making it is dear: the subquery reads it twice.
    """
    listed = words.select(F.col(word_col or words.columns[0]).alias("__w")).where(F.col("__w").isNotNull()).distinct()
    # At least one cell, so that a filter of no words is there and lets nothing pass.
    cells = listed.agg(F.least(F.greatest(F.ceil(F.count(F.lit(1)) * bits_per_word / CELL), F.lit(1)), F.lit(largest // CELL)).cast("long").alias("n"))
    size = cells.scalar() * CELL
    bits = listed.select(F.explode(F.array(*_places(F.col("__w"), size))).alias("at")).select(
        F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit"))
    empty = cells.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("cell"), F.lit(0).cast("long").alias("bit"))
    whole = bits.union(empty).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("cell", "bits")))
    return whole.agg(F.transform(ordered, lambda x: x["bits"]).alias("filter")).scalar()


def might_hold(filter_: Column, word: Column) -> Column:
    """False if ``word`` is surely not among the filter's words."""
    held = F.lit(True)
    for at in _places(word, F.size(filter_).cast("long") * CELL):
        held = held & (F.getbit(F.get(filter_, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(CELL - 1)).cast("int")) == 1)
    return held
