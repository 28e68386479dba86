"""Bronze scan: `;`-delimited files whose headers differ from file to file.

Tasks read the header lines (a few KB a file) into a table; the driver receives one row per distinct
header. One read of all files splits their lines into fields by position, the table says which header a
line's file has, and expressions pick each column's field. So neither the number of files nor that of
headers in a folder changes the plan, and what is wrong with a line is judged in the same read.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litro.operators.copies import with_place
from litro.schemas import CRITICAL_HEADINGS, PARTITION, RAW_HEADINGS, ROW, STATE
from litro.session import stage, work_folder
from litro.sources.files import partition_metadata
from litro.sources.remote import first_line

DELIMITER = ";"
QUOTE = '"'
#: The reader's column for a line that does not have as many fields as it was told.
LINE = "_line"
#: What the reader makes of bytes that are not UTF-8.
REPLACEMENT = "\ufffd"
#: The start of a field, and the field as the reader takes it: a quote counts only at the start; what follows the
#: closing one belongs to the field; without a closing one the field is the rest of the line.
FIELD = f'({DELIMITER}|^)(?:{QUOTE}(?:[^{QUOTE}]++|{QUOTE}{QUOTE})*+{QUOTE}[^{DELIMITER}]*+|{QUOTE}[\\s\\S]*+|[^{DELIMITER}]++)?'

SURPLUS, INVALID, BOTH = "campos excedentes", "bytes inválidos", "campos excedentes e bytes inválidos"


@dataclass(frozen=True)
class HeaderShape:
    """The columns of one header."""

    columns: tuple[str, ...]

    @property
    def missing(self) -> list[str]:
        return sorted(set(CRITICAL_HEADINGS) - set(self.columns))

    @property
    def unknown(self) -> list[str]:
        return sorted(set(self.columns) - set(RAW_HEADINGS))


def split_header(line: str) -> list[str]:
    """Headings of a header line; an empty one is named by its position, as Spark does."""
    names = next(csv.reader([line], delimiter=DELIMITER, quotechar=QUOTE), [])
    return [name or f"_c{i}" for i, name in enumerate(names)]


def checked_header(line: bytes) -> tuple[list[str], str | None]:
    """Headings of a raw header line, and why they cannot be used."""
    try:
        columns = split_header(line.decode("utf-8-sig").rstrip("\r"))
    except UnicodeDecodeError:
        return [], "Cabeçalho ilegível"
    repeated = [c for c, n in Counter(c.lower() for c in columns).items() if n > 1]
    return columns, f"Colunas repetidas: {repeated}" if repeated else None


def read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [checked_header(first_line(p)) for p in batch["path"]]
        yield batch.assign(colunas=[c for c, _ in found], erro=[e for _, e in found])


def file_headers(
    spark: SparkSession, root: str, glob: str = "*.csv", keep: Column | None = None
) -> DataFrame:
    """path, arquivo (as `_metadata.file_path` spells it), ano, semestre, colunas (header of the file), erro, pasta.

    keep is a condition on ano and semestre: files of other partitions are not opened.
    """
    files = partition_metadata(spark, root, glob)
    if keep is not None:
        files = files.where(keep)
    return files.mapInPandas(
        read_headers,
        "path string, arquivo string, ano int, semestre int, colunas array<string>, erro string",
    ).withColumn("pasta", F.regexp_replace("path", "/[^/]*$", ""))


def header_drift(headers: DataFrame) -> DataFrame:
    """One row per file and heading that is missing though critical, or present though unknown."""
    known = F.array(*map(F.lit, RAW_HEADINGS))
    critical = F.array(*map(F.lit, CRITICAL_HEADINGS))
    found = F.array_union(
        F.transform(
            F.array_except(critical, "colunas"),
            lambda c: F.struct(c.alias("coluna"), F.lit("missing critical").alias("problema")),
        ),
        F.transform(
            F.array_except("colunas", known),
            lambda c: F.struct(c.alias("coluna"), F.lit("unknown").alias("problema")),
        ),
    )
    return headers.select("path", *PARTITION, F.inline(found))


def header_shapes(headers: DataFrame) -> list[HeaderShape]:
    """The distinct headers, in order of their columns: a row each on the driver, however many files have it."""
    problem = F.min(F.when(F.col("erro").isNotNull(), F.concat_ws(": ", "pasta", "erro"))).alias("problem")
    found = headers.groupBy("colunas").agg(problem).collect()
    if unusable := sorted(r.problem for r in found if r.problem):
        raise ValueError(f"Unusable headers, among others: {unusable}")
    return sorted((HeaderShape(tuple(r.colunas)) for r in found), key=lambda s: s.columns)


def read_fields(
    spark: SparkSession, root: str, width: int, glob: str = "*.csv", **options: str
) -> DataFrame:
    """All files by position: _0, _1, … of each line, its partition and its file; `_line` where the number of fields is not `width`.

    Header lines are left out. `_line` is only computed where it is asked for.
    """
    kinds = [T.StructField(f"_{i}", T.StringType()) for i in range(width)]
    schema = T.StructType([*kinds, T.StructField(LINE, T.StringType())])
    settings = {
        "header": "true",
        "sep": DELIMITER,
        "quote": QUOTE,
        "escape": QUOTE,
        "columnNameOfCorruptRecord": LINE,
        "pathGlobFilter": glob,
        "basePath": root,
    } | options
    return spark.read.schema(schema).options(**settings).csv(root)


def field_count(line: Column) -> Column:
    """Number of fields of a line, by the CSV reader's own rule for quotes."""
    return F.length(F.regexp_replace(line, FIELD, "$1")) + 1


def line_state(line: Column, size: Column, fields: Column) -> Column:
    """What is wrong with a line of a file whose header has `size` columns, or null. fields: all of it, where `_line` is null.

    Surplus fields count even if they are empty. A replacement character counts as bytes that are not UTF-8:
    the reader turns such bytes into one, and a file that holds one already had them before.
    """
    delimiters = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(DELIMITER), F.lit("")))
    # The pattern is only tried on lines with too many delimiters. A null line has as many fields as were read, which is one too many.
    surplus = line.isNull() | ((delimiters >= size) & (field_count(line) > size))
    invalid = F.contains(F.coalesce(line, fields), F.lit(REPLACEMENT))
    return F.when(surplus & invalid, BOTH).when(surplus, SURPLUS).when(invalid, INVALID)


def scan_bronze(
    spark: SparkSession,
    root: str,
    glob: str = "*.csv",
    headers: DataFrame | None = None,
    keep: Column | None = None,
    with_state: bool = False,
    **options: str,
) -> DataFrame:
    """Union by name over all headers; a column a file lacks is null there.

    headers is the table of `file_headers`, best staged: its size on disk then decides how it is joined. keep
    is a condition on ano and semestre. with_state adds `_estado`, what is wrong with a line, and `_linha`, a
    number that keeps such lines apart; both are null for lines in order.
    Quoted line breaks need `multiLine="true"`, which makes files unsplittable; off by default.
    """
    if headers is None:
        headers = stage(file_headers(spark, root, glob, keep), work_folder(spark, "headers"))
    shapes = header_shapes(headers)
    if not shapes:
        raise FileNotFoundError(f"No files {glob} below {root}")
    if not all(s.columns for s in shapes):
        folders = headers.where(F.size("colunas") == 0).select("pasta").distinct()
        raise ValueError(f"Files without a header line: {sorted(r.pasta for r in folders.collect())}")
    width = max(len(s.columns) for s in shapes) + 1
    lines = read_fields(spark, root, width, glob, **options)
    if keep is not None:
        lines = lines.where(keep)
    fields = [f"_{i}" for i in range(width)]
    wanted = [*fields, LINE] if with_state else fields
    partition = [F.col(c).cast("int").alias(c) for c in PARTITION]
    if len(shapes) == 1:
        lines = lines.select(*wanted, *partition, F.lit(0).alias("_shape"))
    else:
        known = F.array(*[F.array(*map(F.lit, s.columns)) for s in shapes])
        number = (F.array_position(known, F.col("colunas")) - 1).cast("int")
        lines = lines.select(*wanted, *partition, F.col("_metadata.file_path").alias("_file"))
        lines = lines.join(headers.select(F.col("arquivo").alias("_file"), number.alias("_shape")), "_file", "left")
        late = F.raise_error(F.concat(F.lit("No header was read of "), F.col("_file"))).cast("boolean")
        lines = lines.where(F.col("_shape").isNotNull() | late)

    def by_shape(values: list[Column | None]) -> Column:
        """One of the values, the most frequent of them without a test."""
        keys = [None if v is None else v._jc.toString() for v in values]
        usual = max(set(keys), key=keys.count)
        out = next(v for v, key in zip(values, keys, strict=True) if key == usual)
        out = F.lit(None) if out is None else out
        for key in sorted({k for k in keys if k != usual}, key=str):
            shapes_of = [k for k, other in enumerate(keys) if other == key]
            value = F.lit(None) if key is None else values[shapes_of[0]]
            out = F.when(F.col("_shape").isin(shapes_of), value).otherwise(out)
        return out

    def column(name: str) -> Column:
        places = [s.columns.index(name) if name in s.columns else None for s in shapes]
        return by_shape([None if i is None else F.col(f"_{i}") for i in places])

    names = list(dict.fromkeys(c for s in shapes for c in s.columns))
    chosen = [column(c).alias(c) for c in names] + [F.col(c) for c in PARTITION]
    if with_state:
        size = by_shape([F.lit(len(s.columns)) for s in shapes])
        chosen.append(line_state(F.col(LINE), size, F.concat_ws(DELIMITER, *fields)).alias(STATE))
    scanned = lines.select(*chosen)
    if with_state:
        scanned = scanned.withColumn(ROW, F.when(F.col(STATE).isNotNull(), F.monotonically_increasing_id()))
    return scanned


def stage_lines(scanned: DataFrame, target: str) -> DataFrame:
    """A scan's rows as a table, for work that reads them several times: the text is parsed once, and the table is a
    fraction of it. Each row has its place in the map of copies. Columns are staged under numbers, so that a heading
    may be any text."""
    placed = with_place(scanned)
    numbers = [f"c{i}" for i in range(len(placed.columns))]
    return stage(placed.toDF(*numbers), target).toDF(*placed.columns)


def malformed_rows(scanned: DataFrame) -> DataFrame:
    """(ano, semestre, campos_excedentes, bytes_invalidos) of a scan with state: rows with more fields than their
    header, and rows whose bytes are not UTF-8. Partitions without any are left out."""
    count = lambda *states: F.count_if(F.col(STATE).isin(*states))
    return (
        scanned.where(F.col(STATE).isNotNull())
        .groupBy(*PARTITION)
        .agg(count(SURPLUS, BOTH).alias("campos_excedentes"), count(INVALID, BOTH).alias("bytes_invalidos"))
    )
