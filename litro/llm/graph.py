"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litro.llm.common import cut

LINKS_OF_A_TASK = 100_000


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b): for every linked id a that is not the least of its component, the least id b.

    links has ids a and b. Each round hangs every id's larger neighbours, then its smaller ones, on
    the least of them, until nothing changes; the number of rounds grows with the logarithm of the
    longest path. An id with a third of all links is a skewed join key, which adaptive execution splits.
    """
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before, now = None, _state(links)
    while now != before and now[0]:
        # Few links need few tasks; their number grows with the links.
        tasks = now[0] // LINKS_OF_A_TASK + 1
        links = links.coalesce(tasks)
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct().coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        down = large.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = cut(down.union(least.select("a", F.col("least").alias("b"))).distinct().coalesce(tasks))
        before, now = now, _state(links)
    return links
