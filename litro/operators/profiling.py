"""Profile of raw partitions, before any cleaning rule is applied."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litro.functions.values import all_null, decimal_places, named, to_date
from litro.operators.cleaning import source_columns
from litro.operators.copies import by_copies, flagged, repeated
from litro.operators.quality import duplicate_keys
from litro.schemas import PARTITION
from litro.session import stage, work_folder

CANDIDATE_KEY = ("CNPJ da Revenda", "Produto", "Data da Coleta")


def key_collisions(df: DataFrame, by: tuple[str, ...] = PARTITION) -> DataFrame:
    """Complete (retailer, product, date) combinations with more than one row."""
    complete = reduce(lambda a, b: a & b, [named(c).isNotNull() for c in CANDIDATE_KEY])
    return duplicate_keys(df.where(complete), [*by, *CANDIDATE_KEY])


def blank_rows(df: DataFrame) -> DataFrame:
    return df.groupBy(*PARTITION).agg(
        F.count_if(all_null(source_columns(df))).alias("linhas_vazias")
    )


def counted_rows(df: DataFrame, count: str, reread: bool = False) -> DataFrame:
    """Every distinct row and how often it comes. reread: for a source that is cheap to read three times; only
    rows that may have a copy are then shuffled."""
    alone, others = by_copies(df) if reread else (None, df)
    met = others.groupBy(*[named(c) for c in others.columns]).agg(F.count(F.lit(1)).alias(count))
    return met if alone is None else alone.withColumn(count, F.lit(1).cast("bigint")).unionAll(met)


def exact_duplicates(df: DataFrame, reread: bool = False) -> DataFrame:
    """Rows minus distinct rows, per partition; repeated blank rows count."""
    distinct = counted_rows(df, "n", reread)
    return distinct.groupBy(*PARTITION).agg(F.sum(F.col("n") - 1).alias("duplicatas_exatas"))


def null_counts(df: DataFrame) -> DataFrame:
    """(ano, semestre, coluna, nulos) for columns that have nulls; one scan."""
    columns = source_columns(df)
    counts = df.groupBy(*PARTITION).agg(
        *[F.count_if(named(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("coluna"), F.col(f"n{i}").alias("nulos"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(*PARTITION, F.inline(pairs)).where("nulos > 0")


def max_decimal_places(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(decimal_places(named(column))).alias("maximo_casas_decimais"))


#: Measures of a profile's counted rows. The values listed are those of LISTED.
PATTERN, KEY, VALUE = "padrao", "chave", "valor"
LISTED = ("Produto", "Unidade de Medida", "Data da Coleta")
#: A value list in the profile itself holds so many of the first values; the counted rows have all.
MOST_LISTED = 1000


def counted_values(df: DataFrame, reread: bool = False) -> DataFrame:
    """(medida, ano, semestre, coluna, valor, n, copias): all that a profile needs to know, counted in long rows.

    medida `valor`: rows by value of a listed column, null among them; `chave`: rows by complete candidate key;
    `padrao`: rows by which columns are null, a 1 or 0 for each. copias of them equal an earlier row.

    One scan: whole rows are counted first, with map-side combine, and what is left of them is counted by measure and
    value, so neither a frequent row nor a frequent value meets in one task. With `reread` (see counted_rows) there
    are four, and of the keys only those are counted that may come in several rows, by their fingerprints.
    """
    columns = source_columns(df)
    distinct = counted_rows(df, "_n", reread)

    def entry(measure: str, column: str | None, value: Column) -> Column:
        return F.struct(F.lit(measure).alias("medida"), F.lit(column).cast("string").alias("coluna"), value.alias("valor"))

    complete = reduce(lambda a, b: a & b, [named(c).isNotNull() for c in CANDIDATE_KEY])
    # Lengths tell keys apart whose parts would read alike when joined.
    key = F.concat_ws(":", *[F.length(named(c)) for c in CANDIDATE_KEY], *[named(c) for c in CANDIDATE_KEY])
    if reread:
        parts = [named(c) for c in (*PARTITION, *CANDIDATE_KEY)]
        distinct = flagged(distinct, repeated(df.where(complete).select(*parts)), F.xxhash64(*parts), "_varias")
        complete = complete & F.col("_varias")
    pattern = F.concat(*[F.when(named(c).isNull(), "1").otherwise("0") for c in columns])
    entries = F.array(
        entry(PATTERN, None, pattern),
        entry(KEY, None, F.when(complete, key)),
        *[entry(VALUE, c, named(c)) for c in LISTED if c in columns],
    )
    long = distinct.select(*PARTITION, "_n", F.inline(entries)).where((F.col("medida") != KEY) | F.col("valor").isNotNull())
    return long.groupBy("medida", *PARTITION, "coluna", "valor").agg(
        F.sum("_n").alias("n"), F.sum(F.col("_n") - 1).alias("copias")
    )


def value_rows(counted: DataFrame) -> DataFrame:
    """(ano, semestre, coluna, valor, n): every value of the listed columns and its rows, null included."""
    return counted.where(F.col("medida") == VALUE).select(*PARTITION, "coluna", "valor", "n")


def value_lists(counted: DataFrame, columns: Sequence[str], most: int = MOST_LISTED) -> DataFrame:
    """(ano, semestre, a list for each column): the first `most` values in order, null first if there is one."""
    order = Window.partitionBy(*PARTITION, "coluna").orderBy(F.asc_nulls_first("valor"))
    first = value_rows(counted).where(F.col("coluna").isin(*columns)).withColumn("i", F.row_number().over(order)).where(F.col("i") <= most)
    # Entries sort by place; a list skips nulls, a struct does not.
    listed = [
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("coluna") == c, F.struct("i", "valor")))), lambda x: x["valor"]
        ).alias(c)
        for c in columns
    ]
    return first.groupBy(*PARTITION).agg(*listed)


def partition_profile(df: DataFrame, reread: bool = False) -> DataFrame:
    """One row per partition: sizes, dates, products, units, collisions, duplicates, blanks, nulls.

    Unreadable dates are counted and left out of the earliest and latest. Lists of products and units hold
    their first values, at most MOST_LISTED; `value_rows` has all of them. The counted rows are staged in
    the shared working folder, one folder a measure, and every metric reads them there. Of the keys only those
    of several rows are, as no metric asks for others.
    """
    counted = counted_values(df, reread).where((F.col("medida") != KEY) | (F.col("n") > 1))
    counted = stage(counted, work_folder(df.sparkSession, "profile"), "medida")
    return profile_of_counts(counted, source_columns(df))


def profile_of_counts(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    patterns = counted.where(F.col("medida") == PATTERN)
    blank = F.col("valor") == "1" * len(columns)
    sizes = patterns.groupBy(*PARTITION).agg(
        F.sum("n").alias("total_linhas"),
        F.lit(len(columns)).cast("bigint").alias("total_colunas"),
        F.sum("copias").alias("duplicatas_exatas"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("linhas_vazias"),
        F.array(*[F.lit(c) for c in columns]).alias("colunas"),
        F.map_filter(
            F.map_from_arrays(
                F.array(*[F.lit(c) for c in columns]),
                F.array(*[F.sum(F.when(F.substring("valor", i + 1, 1) == "1", F.col("n")).otherwise(0)) for i in range(len(columns))]),
            ),
            lambda _, n: n > 0,
        ).alias("nulos"),
    )
    dates = value_rows(counted).where(F.col("coluna") == "Data da Coleta")
    day = to_date(F.col("valor"), strict=False)
    unreadable = F.col("valor").isNotNull() & day.isNull()
    dates = dates.groupBy(*PARTITION).agg(
        F.min(day).alias("data_minima"),
        F.max(day).alias("data_maxima"),
        F.sum(F.when(unreadable, F.col("n")).otherwise(0)).alias("datas_ilegiveis"),
    )
    repeated = F.count_if(F.col("n") > 1).alias("colisoes_chave_candidata")
    collisions = counted.where(F.col("medida") == KEY).groupBy(*PARTITION).agg(repeated)
    lists = value_lists(counted, ("Produto", "Unidade de Medida")).withColumnsRenamed(
        {"Produto": "produtos", "Unidade de Medida": "unidades_de_medida"}
    )
    by = list(PARTITION)
    whole = sizes.join(dates, by, "left").join(collisions, by, "left").join(lists, by, "left")
    return whole.na.fill(0, ["datas_ilegiveis", "colisoes_chave_candidata"])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values."""
    value = named(column).alias("valor")
    return df.select(value).where(F.col("valor").isNotNull()).distinct()


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in ascending order, null (if any) first."""
    return df.select(named(column).alias("valor")).distinct().orderBy(F.asc_nulls_first("valor"))
