"""Quality rules as violation columns; one aggregate counts them all.

A report is a table (…, check, violations). `enforce` raises for the first violated rule, in the
order the rules are listed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litro.functions.values import CNPJ_PATTERN
from litro.schemas import (
    DIMENSION,
    GOLD,
    GOLD_GRAIN,
    GOLD_REQUIRED,
    PRODUCTS,
    SILVER,
    SILVER_REQUIRED,
    STATES,
    UNITS,
    names_and_types,
)


@dataclass(frozen=True)
class Rule:
    """`violated` is true for a bad row; null counts as not violated."""

    check: str
    violated: Column


def not_allowed(column: str, allowed: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)


def required_rules(columns: Sequence[str]) -> list[Rule]:
    return [Rule(f"required_{c}", F.col(c).isNull()) for c in columns]


def price_rule() -> Rule:
    price = F.col("valor_venda")
    return Rule("price_positive", price.isNull() | (price <= 0))


def cnpj_rule() -> Rule:
    return Rule("cnpj_format", ~F.col("cnpj_revenda").rlike(CNPJ_PATTERN))


def category_rules(
    products: Sequence[str] = PRODUCTS, units: Sequence[str] = UNITS
) -> list[Rule]:
    return [
        Rule("allowed_produto", not_allowed("produto", products)),
        Rule("allowed_unidade_medida", not_allowed("unidade_medida", units)),
    ]


def silver_rules(
    products: Sequence[str] = PRODUCTS,
    units: Sequence[str] = UNITS,
    states: Sequence[str] = STATES,
) -> list[Rule]:
    return [
        price_rule(),
        *category_rules(products, units),
        *required_rules(SILVER_REQUIRED),
        cnpj_rule(),
        Rule("allowed_uf", not_allowed("uf", states)),
    ]


def metrics_rule() -> Rule:
    not_positive = [
        F.col(c) <= 0
        for c in ("preco_medio", "preco_mediano", "preco_minimo", "preco_maximo", "qtd_coletas")
    ]
    inverted = F.col("preco_minimo") > F.col("preco_maximo")
    return Rule("metrics", reduce(lambda a, b: a | b, [*not_positive, inverted]))


def gold_rules() -> list[Rule]:
    return [*required_rules(GOLD_REQUIRED), metrics_rule()]


def report(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """All rules in one pass; one row per rule (and partition, if `by` is given)."""
    counts = df.groupBy(*by).agg(*[F.count_if(r.violated).alias(r.check) for r in rules])
    return counts.unpivot(list(by), [r.check for r in rules], "check", "violations")


def enforce(violations: DataFrame, rules: Sequence[Rule], layer: str) -> None:
    """Raises for the first violated rule. The report has one row per rule, so it is collected."""
    found = {r.check: r.violations for r in violations.where("violations > 0").collect()}
    for check in [r.check for r in rules]:
        if check in found:
            raise ValueError(f"{layer}: {found[check]} rows violate {check}. All: {found}")


def offending_values(df: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """(coluna, valor, linhas): non-null values outside their allow-list."""
    faulty = reduce(lambda a, b: a | b, [not_allowed(c, vs) for c, vs in allowed.items()])
    values = df.where(faulty).groupBy(*allowed).agg(F.count(F.lit(1)).alias("linhas"))
    long = values.unpivot(["linhas"], list(allowed), "coluna", "valor")
    outside = reduce(
        lambda a, b: a | b,
        [(F.col("coluna") == c) & not_allowed("valor", vs) for c, vs in allowed.items()],
    )
    return long.where(outside).groupBy("coluna", "valor").agg(F.sum("linhas").alias("linhas"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("quantidade")).where("quantidade > 1")


def count_as_check(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check"), "violations"
    )


def grain_report(gold: DataFrame) -> DataFrame:
    return count_as_check(duplicate_keys(gold, GOLD_GRAIN), "grain")


def gold_report(gold: DataFrame) -> DataFrame:
    return grain_report(gold).unionByName(report(gold, gold_rules()))


def published_report(files: DataFrame) -> DataFrame:
    """(ano, arquivo, linhas, check, violations): what is wrong with each published file.

    files are Gold rows with `ano`, the value of their folder, and `arquivo`, the file they lie in. Checks are
    those of `gold_rules`; `grain`, rows whose grain occurs more than once in any file; and `folder`, rows of
    another year than their folder's.
    """
    rules = [*gold_rules(), Rule("folder", F.coalesce(F.year("ano_mes") != F.col("ano"), F.lit(True)))]
    by = ["ano", "arquivo"]
    counts = files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("linhas"), *[F.count_if(r.violated).alias(r.check) for r in rules]
    )
    # A grain counts once a file before its files meet.
    grains = files.groupBy(*GOLD_GRAIN, *by).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*GOLD_GRAIN))
    repeated = grains.withColumn("total", total).where("total > 1").groupBy(*by).agg(F.sum("n").alias("grain"))
    whole = counts.join(repeated, by, "left").withColumn("grain", F.coalesce("grain", F.lit(0).cast("bigint")))
    return whole.unpivot([*by, "linhas"], [r.check for r in rules] + ["grain"], "check", "violations")


def dimension_report(dimension: DataFrame) -> DataFrame:
    """Emptiness, nulls and unique codes of the municipality dimension."""
    required = required_rules(DIMENSION.fieldNames())
    empty = dimension.agg((F.count(F.lit(1)) == 0).cast("bigint").alias("violations")).select(
        F.lit("not_empty").alias("check"), "violations"
    )
    unique = count_as_check(duplicate_keys(dimension, ["codigo_ibge"]), "unique_codigo_ibge")
    return empty.unionByName(report(dimension, required)).unionByName(unique)


def require_columns(df: DataFrame, schema: T.StructType, layer: str) -> None:
    """Same set of columns; the order is free."""
    missing = sorted(set(schema.fieldNames()) - set(df.columns))
    surplus = sorted(set(df.columns) - set(schema.fieldNames()))
    if missing or surplus:
        raise ValueError(f"{layer}: missing columns {missing}, unexpected columns {surplus}")


def require_types(df: DataFrame, schema: T.StructType, layer: str) -> None:
    for name, kind in names_and_types(schema):
        if name in df.columns and df.schema[name].dataType != kind:
            raise ValueError(f"{layer}: {name} is {df.schema[name].dataType}, expected {kind}")


def require_schema(df: DataFrame, schema: T.StructType, layer: str) -> None:
    """Same names and types in the same order."""
    if names_and_types(df.schema) != names_and_types(schema):
        raise ValueError(f"{layer}: schema is {df.schema}, expected {schema}")


def validate_silver(df: DataFrame, rules: Sequence[Rule] | None = None) -> None:
    rules = rules or silver_rules()
    require_columns(df, SILVER, "Silver")
    require_types(df, SILVER, "Silver")
    enforce(report(df, rules), rules, "Silver")


def validate_grain(gold: DataFrame) -> None:
    repeated = grain_report(gold).first().violations
    if repeated:
        raise ValueError(f"Gold: {repeated} combinações duplicadas of {GOLD_GRAIN}")


def validate_gold(gold: DataFrame) -> None:
    require_schema(gold, GOLD, "Gold")
    validate_grain(gold)
    rules = gold_rules()
    enforce(report(gold, rules), rules, "Gold")


def validate_dimension(dimension: DataFrame) -> None:
    require_schema(dimension, DIMENSION, "Municipality dimension")
    found = {r.check: r.violations for r in dimension_report(dimension).collect()}
    broken = {check: n for check, n in found.items() if n}
    if broken:
        raise ValueError(f"Municipality dimension: {broken}")
