import datetime
import random
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from litro.functions import text, values


def column(spark, entries, expression, kind="string"):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(entries)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_only_the_first_comma_becomes_a_point(spark):
    got = column(spark, ["5,89", "1,234,5", "6", ",5", None], values.decimal_comma)
    assert got == ["5.89", "1.234,5", "6", ".5", None]


def test_digits_of_any_script_are_kept(spark):
    got = column(spark, ["11.222/0001-44", "a٣b", "", None], values.digits_only)
    assert got == ["11222000144", "٣", "", None]


def test_unit_spelling_replaces_whole_values(spark):
    got = column(spark, ["R$ / m3", "R$ / litro", "xR$ / m3", None], values.unit_spelling)
    assert got == ["R$ / m³", "R$ / litro", "xR$ / m3", None]


def test_dates(spark):
    got = column(spark, ["07/03/2024", None], values.to_date)
    assert got == [datetime.date(2024, 3, 7), None]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["31/02/2024", "2024-03-07", "x", "7/3/24"])
def test_unreadable_date_fails_whatever_the_session_says(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="Invalid date"):
            column(spark, [bad], values.to_date)
        assert column(spark, [bad], lambda c: values.to_date(c, strict=False)) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_prices(spark):
    got = column(spark, ["5.89", "6", None], values.to_price)
    assert [None if v is None else str(v) for v in got] == ["5.89", "6.00", None]


@pytest.mark.parametrize("bad", ["1.234,5", "1.234.56", "abc", "123456789.00"])
def test_unreadable_price_fails(spark, bad):
    with pytest.raises(PySparkException, match="Invalid price"):
        column(spark, [bad], values.to_price)
    assert column(spark, [bad], lambda c: values.to_price(c, strict=False)) == [None]


def test_month_stays_a_date(spark):
    assert column(spark, [datetime.date(2024, 3, 7)], values.month_of, "date") == [
        datetime.date(2024, 3, 1)
    ]


def test_decimal_places(spark):
    got = column(spark, ["5.89", "5", "5.", "1.2.345", "5,891", None], values.decimal_places)
    assert got == [2, 0, 0, 1, 0, 0]


def test_rounding_is_half_away_on_the_binary_value(spark):
    got = column(
        spark, [1.005, 2.5, -0.125, 0.125, None], lambda c: values.half_away(c, 2), "double"
    )
    assert got == [1.0, 2.5, -0.13, 0.13, None]


def test_fold_examples(spark):
    names = ["São Paulo", "Mogi-Mirim", "Olho d'Água", "  a  b ", "ß½ﬁ", "", None, "日本 7"]
    expected = ["SAO PAULO", "MOGIMIRIM", "OLHO DAGUA", "  A  B ", "SS12FI", "", None, " 7"]
    assert [text.fold_plain(n) for n in names] == expected
    assert column(spark, names, text.fold_text) == expected
    assert column(spark, names, text.fold_text_udf) == expected


def test_native_fold_equals_the_definition_for_every_character(spark):
    codes = spark.range(0, 0x110000, numPartitions=8).where("id < 55296 OR id > 57343")
    chars = codes.mapInPandas(
        lambda parts: (p.assign(t=["x" + chr(i) + "1" for i in p["id"]]) for p in parts),
        "id bigint, t string",
    )
    both = chars.select(
        "id", text.fold_text(F.col("t")).alias("a"), text.fold_text_udf(F.col("t")).alias("b")
    )
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).limit(5).collect() == []


def test_native_fold_equals_the_definition_on_mixed_text(spark):
    draw = random.Random(7)
    pool = [c for c in map(chr, range(0x20, 0x3400)) if unicodedata.category(c) != "Cs"]
    texts = ["".join(draw.choices(pool, k=draw.randint(0, 40))) for _ in range(500)]
    assert column(spark, texts, text.fold_text) == [text.fold_plain(t) for t in texts]


def test_exact_mean_does_not_depend_on_order(spark):
    """Values whose double sum changes with their order; equal bits from any partitioning."""
    from fractions import Fraction

    draw = random.Random(2)
    numbers = [draw.choice([0.1, 1e10 / 3, 1e-9 / 7, 5.675, -3.3333333333]) * draw.random() for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in [*numbers, None]], "v double")
    means = set()
    for parts in (1, 3, 7, 16):
        shuffled = frame.repartition(parts).sortWithinPartitions(F.rand(parts))
        means.add(shuffled.agg(values.exact_mean(F.col("v")).alias("m")).first().m)
    true = sum(map(Fraction, numbers)) / len(numbers)
    assert len(means) == 1 and abs(Fraction(means.pop()) - true) < Fraction(1, 10**6)
    assert frame.where("v IS NULL").agg(values.exact_mean(F.col("v")).alias("m")).first().m is None
    ties = spark.createDataFrame([(v,) for v in [5.12, 5.13, 5.13, 5.12] * 100], "v double")
    assert ties.agg(values.exact_mean(F.col("v")).alias("m")).first().m == 5.125
    for bad in (float("nan"), float("inf"), 1e12):
        with pytest.raises(Exception, match="Not summable"):
            spark.createDataFrame([(bad,)], "v double").agg(values.exact_mean(F.col("v"))).collect()
