"""Finding copies without shuffling rows that have none."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from litro.operators import copies
from litro.operators.cleaning import drop_exact_duplicates
from litro.operators.profiling import exact_duplicates

COLUMNS = "a string, b string, ano int, semestre int"


def rows_with_copies():
    dice = random.Random(7)
    some = [(dice.choice(["x", "y", "", None]), dice.choice(["x", "y", "", None]), dice.choice([2000, None]), 1) for _ in range(60)]
    return some + [(f"k{i}", None, 2001, 2) for i in range(300)] + [("hot", "hot", 2001, 1)] * 200


@pytest.mark.parametrize("bits", [27, 7])
def test_every_distinct_row_stays_once(spark, monkeypatch, bits):
    """With a map of two words, too, in which rows without a copy meet a bit."""
    monkeypatch.setattr(copies, "MAP_BITS", bits)
    rows = rows_with_copies()
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert Counter(map(tuple, drop_exact_duplicates(df, reread=True).collect())) == Counter(set(rows))
    alone, others = (Counter(map(tuple, part.collect())) for part in copies.by_copies(df))
    assert alone + others == Counter(rows)
    assert all(n == 1 for n in alone.values()) and not set(alone) & set(others)


def test_copies_are_counted_by_partition(spark):
    df = spark.createDataFrame(rows_with_copies(), COLUMNS)
    expected = Counter()
    for row, n in Counter(rows_with_copies()).items():
        expected[row[2:]] += n - 1
    assert {(r.ano, r.semestre): r.duplicatas_exatas for r in exact_duplicates(df, reread=True).collect()} == dict(expected)


def test_rows_without_a_copy_are_not_shuffled(spark, tmp_path):
    """Of 20,000 different rows of 400 bytes only fingerprints move: the copies part is empty, the other has no exchange."""
    text = F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 400))
    spark.range(20_000).select(text.alias("a"), F.lit(1).alias("ano"), F.lit(1).alias("semestre")).write.parquet(str(tmp_path / "t"))
    alone, others = copies.by_copies(spark.read.parquet(str(tmp_path / "t")))
    assert alone.count() == 20_000 and others.isEmpty()
    alone.write.format("noop").mode("overwrite").save()
    plan = alone._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
