"""Raw files to validated Silver partitions, all pending partitions in one job."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.operators.cleaning import to_silver
from litro.operators.contract import require_contract
from litro.operators.quality import Rule, report, silver_rules
from litro.schemas import PARTITION, SILVER, STATE
from litro.session import scratch_folder, stage
from litro.sources.commit import publish_folders
from litro.sources.delimited import (
    BOTH,
    INVALID,
    SURPLUS,
    file_headers,
    header_drift,
    scan_bronze,
    stage_lines,
)
from litro.sources.files import partitions, pending
from litro.sources.layers import PARQUET

logger = logging.getLogger(__name__)


IN_ORDER = "em ordem"
#: Staged rows lie in folders by the state of their line, then by partition.
FOLDERS = (STATE, *PARTITION)


def partition_filter(keys: Sequence[tuple[int, int]]):
    """Condition for a few partitions, as literals, so folders are pruned when planning."""
    return reduce(
        lambda a, b: a | b,
        [(F.col("ano") == ano) & (F.col("semestre") == half) for ano, half in keys],
        F.lit(False),
    )


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    rules: Sequence[Rule] | None = None,
    glob: str = "*.csv",
) -> list[tuple[int, int]]:
    """Publishes every pending partition that passes the rules; returns their (ano, semestre).

    A partition with an unusable header, a missing critical heading, a row of too many fields, bytes
    that are not UTF-8, a violated rule or no row left is not published and, once the others are,
    reported in one error. Partitions that already have Silver files are skipped.

    The raw text is read once, into a staged table of its fields. Fingerprints tell which of its rows may have a
    copy; those are shuffled twice, to find copies and by partition, and the others not at all. Clean partitions
    are then published as they were staged, by renames.
    """
    with scratch_folder(spark, "bronze-to-silver") as work:
        return _publish_pending(spark, bronze, silver, list(rules or silver_rules()), glob, work)


def _publish_pending(
    spark: SparkSession, bronze: str, silver: str, rules: list[Rule], glob: str, work: str
) -> list[tuple[int, int]]:
    todo = pending(partitions(spark, bronze, glob), partitions(spark, silver, PARQUET)).collect()
    if not todo:
        return []
    for row in todo:
        if row.arquivos > 1:
            logger.info("%s files read together in %s/%s", row.arquivos, row.ano, row.semestre)
    keys = [(r.ano, r.semestre) for r in todo]
    headers = stage(file_headers(spark, bronze, glob, partition_filter(keys)), f"{work}/headers")
    problems: dict[tuple[int, int], dict] = {}
    unusable = headers.where("erro IS NOT NULL").select(*PARTITION, "erro").distinct()
    for row in unusable.collect():  # a few texts per partition
        problems.setdefault((row.ano, row.semestre), {})[row.erro] = "cabeçalho"
    drift = header_drift(headers.where("erro IS NULL")).select(*PARTITION, "coluna", "problema").distinct()
    for row in drift.collect():  # at most a heading or two per partition
        if row.problema == "unknown":
            logger.warning("Unknown column %s in %s/%s", row.coluna, row.ano, row.semestre)
        else:
            found = problems.setdefault((row.ano, row.semestre), {})
            found.setdefault("Colunas críticas ausentes", []).append(row.coluna)
    good = [k for k in keys if k not in problems]
    if good:
        rows = rows_to_stage(spark, bronze, glob, headers, partition_filter(good), f"{work}/lines")
        require_contract(rows.drop(*FOLDERS), SILVER, "Silver")
        staged = stage(rows, f"{work}/silver", *FOLDERS)
        for key, found in malformed(staged).items():
            problems.setdefault(key, {}).update(found)
        sound = staged.where(F.col(STATE) == IN_ORDER)
        present = set()
        for row in report(sound, rules, PARTITION).collect():  # a row per partition and rule
            present.add((row.ano, row.semestre))
            if row.violations:
                problems.setdefault((row.ano, row.semestre), {})[row.check] = row.violations
        for key in set(good) - present - set(problems):
            problems[key] = {"Nenhuma linha": 0}
        good = [k for k in good if k not in problems]
        names = [f"ano={ano}/semestre={half}" for ano, half in sorted(good)]
        publish_folders(spark, f"{work}/silver/{STATE}={IN_ORDER}", silver, names)
    if problems:
        raise ValueError(f"Silver partitions not published: {dict(sorted(problems.items()))}")
    return sorted(good)


def rows_to_stage(
    spark: SparkSession, bronze: str, glob: str, headers: DataFrame, keep: Column, lines: str | None = None
) -> DataFrame:
    """Silver rows of some partitions with the state of their lines, dealt out for the folders they are staged in.

    lines: a folder for a table of the lines' fields; rows are then taken from it, and only those that may have a
    copy are shuffled. Without it the text itself is shuffled, all of it.
    """
    raw = scan_bronze(spark, bronze, glob, headers.where(keep), keep, with_state=True)
    if lines:
        raw = stage_lines(raw, lines)
    rows = to_silver(raw, strict=False, reread=bool(lines), deal=FOLDERS)
    return rows.withColumn(STATE, F.coalesce(STATE, F.lit(IN_ORDER)))


def malformed(staged: DataFrame) -> dict[tuple[int, int], dict[str, int]]:
    """Numbers of lines in partitions that have malformed ones; a line with both faults counts for each."""
    found: dict[tuple[int, int], dict[str, int]] = {}
    counts = staged.where(F.col(STATE) != IN_ORDER).groupBy(*PARTITION, STATE).count()
    for row in counts.collect():
        faults = found.setdefault((row.ano, row.semestre), {})
        for name, states in (("Campos excedentes", (SURPLUS, BOTH)), ("Bytes inválidos", (INVALID, BOTH))):
            if row[STATE] in states:
                faults[name] = faults.get(name, 0) + row["count"]
    return found
