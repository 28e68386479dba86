"""Bronze rows to typed Silver rows."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litro.functions.values import (
    all_null,
    decimal_comma,
    digits_only,
    named,
    to_date,
    to_price,
    unit_spelling,
)
from litro.operators.copies import by_copies
from litro.schemas import (
    CRITICAL_HEADINGS,
    OPTIONAL_HEADINGS,
    PARTITION,
    PLACE,
    RAW_HEADINGS,
    ROW,
    SILVER_NAME_OF_HEADING,
    STATE,
)

logger = logging.getLogger(__name__)


def source_columns(df: DataFrame) -> list[str]:
    """Columns that come from the file, not from its path."""
    return [c for c in df.columns if c not in (*PARTITION, PLACE)]


def unknown_headings(df: DataFrame) -> list[str]:
    return sorted(set(source_columns(df)) - set(RAW_HEADINGS) - {STATE, ROW})


def require_critical_headings(df: DataFrame) -> None:
    missing = sorted(set(CRITICAL_HEADINGS) - set(df.columns))
    if missing:
        raise ValueError(f"Colunas críticas ausentes: {missing}")


def warn_unknown_headings(df: DataFrame) -> None:
    unknown = unknown_headings(df)
    if unknown:
        logger.warning("Unknown source columns, dropped by the projection: %s", unknown)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drops rows in which every source column is null."""
    return df.where(~all_null(source_columns(df)))


def drop_exact_duplicates(df: DataFrame, reread: bool = False, deal: Sequence[str] = ()) -> DataFrame:
    """One of each fully identical source row per partition; null equals null.

    Runs before the projection, so rows that differ only in a dropped column stay apart. Copies
    are combined on the map side, so a row repeated very often costs one row per task to shuffle. reread: for
    a source that is cheap to read three times; only rows that may have a copy are then shuffled. deal: columns
    that name the folders rows go to; the shuffled ones are dealt out by them again, the others lie as they did.
    """
    if not reread:
        return dealt(df.dropDuplicates(), deal)
    alone, others = by_copies(df)
    return alone.unionAll(dealt(others.dropDuplicates(), deal))


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *by) if by else df


def add_optional_columns(df: DataFrame) -> DataFrame:
    absent = [c for c in OPTIONAL_HEADINGS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def select_silver_names(df: DataFrame) -> DataFrame:
    """The eleven kept columns under their Silver names; path columns and a line's state pass through."""
    kept = [named(heading).alias(name) for heading, name in SILVER_NAME_OF_HEADING.items()]
    return df.select(*kept, *[c for c in (*PARTITION, STATE) if c in df.columns])


def normalize_values(df: DataFrame, strict: bool = True) -> DataFrame:
    return df.withColumns(
        {
            "cnpj_revenda": digits_only(F.col("cnpj_revenda")),
            "cep": digits_only(F.col("cep")),
            "data_coleta": to_date(F.col("data_coleta"), strict),
            "valor_venda": to_price(decimal_comma(F.col("valor_venda")), strict),
            "unidade_medida": unit_spelling(F.col("unidade_medida")),
        }
    )


def to_silver(df: DataFrame, strict: bool = True, reread: bool = False, deal: Sequence[str] = ()) -> DataFrame:
    """The whole cleaning chain, one lazy plan with one shuffle (the de-duplication, which see for `reread` and `deal`).

    `strict=False` turns unreadable dates and prices into nulls, for callers that report them
    through the quality rules instead of losing the whole job to one bad row. Lines with a state are
    never blank and never copies of each other, so each of them stays to be reported.
    """
    require_critical_headings(df)
    warn_unknown_headings(df)
    return (
        df.transform(drop_blank_rows)
        .transform(drop_exact_duplicates, reread=reread, deal=deal)
        .transform(add_optional_columns)
        .transform(select_silver_names)
        .transform(normalize_values, strict=strict)
    )
