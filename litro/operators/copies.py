"""Which rows may have an identical one, found without moving whole rows.

One pass counts a fingerprint of each row: only those numbers are shuffled. A row whose fingerprint comes once
has no copy and stays in its task. The fingerprints that come more often are kept as bits of a map of bounded
size; rows that meet a bit, all copies and some others, are then compared as they are. So a fingerprint never
decides that two rows are equal, and a crowded map only means that more rows are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litro.functions.values import named
from litro.schemas import PLACE, ROW, STATE

#: The map has 2 ** 27 bits in words of 64. Words without a bit are left out, so at most 2 ** 21 are broadcast.
MAP_BITS, WORD_BITS = 27, 6


def with_place(df: DataFrame) -> DataFrame:
    """Rows with the place in the map of what they say. What is wrong with a line is left out, which need not be
    judged to count fingerprints, and so is its number, as another pass may give it another one. Staged lines
    have their place already."""
    if PLACE in df.columns:
        return df
    return df.withColumn(PLACE, F.xxhash64(*[named(c) for c in df.columns if c not in (STATE, ROW)]))


def word(place: Column) -> Column:
    return F.shiftrightunsigned(place, 64 - MAP_BITS + WORD_BITS)


def bit(place: Column) -> Column:
    """Which of its word's bits, as a number of one bit."""
    at = F.shiftrightunsigned(place, 64 - MAP_BITS).bitwiseAND((1 << WORD_BITS) - 1)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def repeated(df: DataFrame) -> DataFrame:
    """(_palavra, _bits): the words of the map, with a bit for each fingerprint that more than one row has."""
    counted = with_place(df).select(PLACE).groupBy(PLACE).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.groupBy(word(F.col(PLACE)).alias("_palavra")).agg(F.bit_or(bit(F.col(PLACE))).alias("_bits"))


def met(place: Column) -> Column:
    """Whether a place meets a bit of the map, as the condition of a join with its words."""
    return (word(place) == F.col("_palavra")) & (F.col("_bits").bitwiseAND(bit(place)) != 0)


def flagged(df: DataFrame, words: DataFrame, place: Column, flag: str) -> DataFrame:
    """Rows, each once, with a flag: whether their place meets a bit of the map."""
    joined = df.join(F.broadcast(words), met(place), "left")
    return joined.withColumn(flag, F.col("_bits").isNotNull()).drop("_palavra", "_bits")


def by_copies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that have no copy, as they lie, and the rows that may have one. Together they are `df`."""
    words, rows = F.broadcast(repeated(df)), with_place(df)
    shared = met(F.col(PLACE))
    return rows.join(words, shared, "left_anti").drop(PLACE), rows.join(words, shared, "left_semi").drop(PLACE)
