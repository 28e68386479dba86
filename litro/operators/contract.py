"""Comparison of a table with the contract of its layer, as a table of differences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litro.functions.values import named

DROPPED, ADDED, RETYPED, MOVED = "ausente", "inesperada", "tipo", "posição"


@dataclass(frozen=True)
class Difference:
    """One way in which a column departs from the contract; places count from 1, null where there is none."""

    column: str
    problem: str
    expected_type: str | None
    found_type: str | None
    expected_place: int | None
    found_place: int | None


def _longest_common(a: list[str], b: list[str]) -> set[str]:
    """The names of a longest common subsequence: columns that did not move."""
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i] == b[j] else max(length[i + 1][j], length[i][j + 1])
    kept, i, j = set(), 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            kept.add(a[i])
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            i += 1
        else:
            j += 1
    return kept


def differences(found: T.StructType, expected: T.StructType) -> list[Difference]:
    """Dropped, added, retyped and moved columns, in the contract's order, added ones last in the table's own.

    Nullability is not compared: files don't keep it. Moved are the fewest columns that must be moved to
    bring the common ones into the contract's order. A repeated name counts by its first column.
    """
    have = {f.name: f.dataType for f in reversed(found.fields)}
    names = list(dict.fromkeys(found.fieldNames()))
    want = expected.fieldNames()
    still = _longest_common([c for c in want if c in have], [c for c in names if c in set(want)])
    out = []
    for place, field in enumerate(expected.fields, 1):
        kind = field.dataType.simpleString()
        if field.name not in have:
            out.append(Difference(field.name, DROPPED, kind, None, place, None))
            continue
        other, at = have[field.name].simpleString(), names.index(field.name) + 1
        if have[field.name] != field.dataType:
            out.append(Difference(field.name, RETYPED, kind, other, place, at))
        if field.name not in still:
            out.append(Difference(field.name, MOVED, kind, other, place, at))
    for at, name in enumerate(names, 1):
        if name not in want:
            out.append(Difference(name, ADDED, None, have[name].simpleString(), None, at))
    return out


def require_contract(df: DataFrame, expected: T.StructType, layer: str, ordered: bool = True) -> None:
    """Raises with all differences at once. ordered: whether the order of columns matters."""
    found = [d for d in differences(df.schema, expected) if ordered or d.problem != MOVED]
    if found:
        told = "; ".join(f"{d.column}: {d.problem} ({d.expected_type} -> {d.found_type})" for d in found)
        raise ValueError(f"{layer}: {told}")


SCHEMA = (
    "ordem int, coluna string, problema string, tipo_esperado string, tipo_encontrado string, "
    "posicao_esperada int, posicao_encontrada int"
)


def contract_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The differences in order, and what they mean for the rows: valores, non-null values of a column
    that is there; incompativeis, those of a retyped column that the contract's type cannot take.

    One scan of the concerned columns; a table that keeps the contract is not read, and gives no row.
    """
    spark = df.sparkSession
    found = differences(df.schema, expected)
    rows = [
        (k, d.column, d.problem, d.expected_type, d.found_type, d.expected_place, d.found_place)
        for k, d in enumerate(found, 1)
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    present = list(dict.fromkeys(d.column for d in found if d.found_type is not None))
    if not present:
        none = F.lit(None).cast("bigint")
        return table.withColumns({"valores": none, "incompativeis": none})
    retyped = {d.column: d.expected_type for d in found if d.problem == RETYPED}

    def lost(name: str) -> Column:
        if name not in retyped:
            return F.lit(None).cast("bigint")
        return F.count_if(named(name).isNotNull() & named(name).try_cast(retyped[name]).isNull())

    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("coluna"), F.count(named(c)).alias("valores"), lost(c).alias("incompativeis"))
                for c in present
            ]
        ).alias("x")
    ).select(F.inline("x"))
    return table.join(counts, "coluna", "left").select(*table.columns, "valores", "incompativeis")
