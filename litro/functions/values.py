"""Scalar clean-up expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from litro.schemas import PRICE

# Source formats.
DATE_FORMAT = "dd/MM/yyyy"
UNIT_SPELLING = {"R$ / m3": "R$ / m³"}
CNPJ_PATTERN = r"\A\p{Nd}{14}\z"
NOT_A_DIGIT = r"[^\p{Nd}]"


def named(name: str) -> Column:
    """Column by its exact name, whatever characters the heading holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_null(names: Iterable[str]) -> Column:
    """True for a row without any value in the named columns."""
    return reduce(lambda a, b: a & b, [named(n).isNull() for n in names])


def decimal_comma(c: Column) -> Column:
    """First comma becomes a point; a second one stays and makes the later cast fail."""
    at = F.instr(c, ",")
    return F.when(at > 0, F.overlay(c, F.lit("."), at, F.lit(1))).otherwise(c)


def digits_only(c: Column) -> Column:
    """Drops everything but decimal digits of any script."""
    return F.regexp_replace(c, NOT_A_DIGIT, "")


def unit_spelling(c: Column) -> Column:
    """Replaces whole values that are a known variant spelling."""
    out = c
    for variant, official in UNIT_SPELLING.items():
        out = F.when(c == variant, F.lit(official)).otherwise(out)
    return out


def _or_fail(parsed: Column, source: Column, what: str) -> Column:
    problem = F.concat(F.lit(f"Invalid {what}: "), source)
    return F.when(parsed.isNull() & source.isNotNull(), F.raise_error(problem)).otherwise(parsed)


def to_date(c: Column, strict: bool = True) -> Column:
    """Day-month-year text to date. Unreadable text fails the job, or is null if not strict."""
    parsed = F.try_to_date(c, DATE_FORMAT)
    return _or_fail(parsed, c, "date") if strict else parsed


def to_price(c: Column, strict: bool = True) -> Column:
    """Text with a decimal point to a two-place decimal."""
    parsed = c.try_cast(PRICE)
    return _or_fail(parsed, c, "price") if strict else parsed


def month_of(c: Column) -> Column:
    return F.trunc(c, "MM")


def decimal_places(c: Column) -> Column:
    """Characters after the first point, 0 if there is none."""
    return F.coalesce(F.length(F.get(F.split(c, r"\."), F.lit(1))), F.lit(0))


def half_away(x: Column, places: int) -> Column:
    """Rounds the binary value half away from zero, as SQL engines with a double ROUND do.

    `F.round(x, n)` rounds the decimal rendering instead: 1.005 would become 1.01, not 1.0.
    """
    scale = float(10**places)
    return F.round(x * scale) / scale


#: A mean of doubles is taken over decimals of this many places; of values below LARGEST_SUMMED, so many as
#: 10**10 are added up without overflow.
SUMMED_PLACES, LARGEST_SUMMED = 17, 1e11


def exact_mean(x: Column) -> Column:
    """Aggregate: the mean of doubles, the same however the rows are partitioned and ordered; null for no value.

    Each value is rounded to SUMMED_PLACES decimal places, which moves it, and so the mean, by less than 10**-17;
    decimals are then added exactly, and only the last division rounds. A value of LARGEST_SUMMED or more, or one
    that is not finite, fails the job.
    """
    outside = F.raise_error(F.concat(F.lit("Not summable: "), x.cast("string"))).cast("double")
    within = F.when(F.abs(x) < LARGEST_SUMMED, x).when(x.isNotNull(), outside)
    total = F.sum(within.cast(f"decimal(28,{SUMMED_PLACES})"))
    return total.cast("double") / F.nullif(F.count(x), F.lit(0).cast("bigint"))
