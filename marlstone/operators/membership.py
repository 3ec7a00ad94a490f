"""A Bloom filter of a column, made by aggregation and tested by an expression."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.plans.lineage import cut

WORD = 64


class Bloom:
    """Of the values of a column: might_hold() is true for all of them, and for others in about
    ``wrong`` of cases if there are at most ``expected`` values.

    Bits are set by an aggregation with partial results per task, into words of 64. The filter
    is one row, written down once, which its user's plan has as a scalar subquery: some
    1.2 MB for a million values at 1 %, and ``most_bytes`` at most, from where on more
    values pass it wrongly. Null values are not held."""

    def __init__(self, rows: DataFrame, column: str, expected: int, wrong: float = 0.01, most_bytes: int = 1 << 24):
        bits = max(WORD, math.ceil(-max(expected, 1) * math.log(wrong) / math.log(2) ** 2))
        bits = min(bits, most_bytes * 8)
        self.words = -(-bits // WORD)
        self.hashes = max(1, round(self.words * WORD / max(expected, 1) * math.log(2)))
        at = rows.where(F.col(column).isNotNull()).select(F.explode(F.array(*self._places(F.col(column)))).alias("at"))
        words = at.groupBy(F.floor(F.col("at") / WORD).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD).cast("int"))).alias("bits"))
        # one row: all words of the filter in their order, whose number is set above
        every = rows.sparkSession.range(self.words).select(F.col("id").cast("int").alias("word")).join(words, "word", "left")
        listed = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
        self.row = cut(every.agg(listed.alias("l")).select(F.transform("l", lambda w: w["bits"]).alias("words")))

    def _places(self, value: Column) -> list[Column]:
        """Numbers of the bits of a value, by double hashing."""
        size = F.lit(self.words * WORD)
        a, b = F.pmod(F.xxhash64(value, F.lit(1)), size), F.pmod(F.xxhash64(value, F.lit(2)), size)
        return [F.pmod(a + i * b, size) for i in range(self.hashes)]

    def might_hold(self, value: Column) -> Column:
        words, there = self.row.scalar(), value.isNotNull()
        for at in self._places(value):  # a subquery can't stand inside a function of arrays
            there = there & (F.getbit(F.get(words, F.floor(at / WORD).cast("int")), (at % WORD).cast("int")) == 1)
        return there
