"""Layer folders derived from the tables, for the queries about sources, sinks and whole jobs.

Each is written by Spark once per session and table folder, below the shared working folder.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from functools import partial, wraps

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.functions.values import named
from litro.operators.monthly import monthly_prices
from litro.plans.bronze_to_silver import bronze_to_silver
from litro.plans.municipalities import build_dimension
from litro.plans.silver_to_gold import silver_to_gold
from litro.schemas import GOLD, PARTITION, RAW_HEADINGS
from litro.session import open_folders, stage, work_folder
from litro.sources.archives import land_archives
from litro.sources.layers import publish_gold, publish_silver
from litro.sources.remote import open_filesystem, qualified
from litro.workload import views

_written: dict[tuple, str] = {}

CSV = {"header": "true", "sep": ";", "quote": '"', "escape": '"'}


def once(build: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """Runs `build(spark, sf_dir, target)` at most once; returns the folder it filled."""

    @wraps(build)
    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _written:
            target = work_folder(spark, build.__name__)
            build(spark, sf_dir, target)
            _written[key] = target
        return _written[key]

    return folder


@once
def observations(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The joined tables, stored by partition: every other layer is cut from them. Rows stay in the task that
    joined them, so they are not shuffled again for their folders."""
    stage(views.observations(spark, sf_dir), target, *PARTITION)


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(observations(spark, sf_dir))


def raw_versions(obs: DataFrame) -> list[DataFrame]:
    """Raw text by header, which drifts: complete in most years; without the brand up to 1996; with a new column, in
    another order, from 2000 on."""
    raw = views.raw(obs)
    data = [c for c in raw.columns if c not in PARTITION]
    year = F.col("ano")
    return [
        raw.where((year > 1996) & (year < 2000)),
        raw.where(year <= 1996).drop("Bandeira"),
        raw.where(year >= 2000)
        .withColumn("Origem", F.when(F.col("Produto").isNotNull(), F.lit("coleta")))
        .select("Origem", *["`" + c + "`" for c in reversed(data)], *PARTITION),
    ]


@once
def bronze(spark: SparkSession, sf_dir: str, target: str) -> None:
    """CSV files of the raw text. Observations lie by partition already, so it is written by the tasks that read them."""
    with open_folders(spark):
        for version in raw_versions(observed(spark, sf_dir)):
            version.write.mode("append").options(**CSV).partitionBy(*PARTITION).csv(target)


@contextmanager
def one_row_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of one row, for rows that hold whole files."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@once
def archives(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The raw text as Bronze has it, zipped in the same folder layout: an archive of one file for each header,
    task and partition. Text goes into the archives line by line, so it lies on disk packed only."""
    for number, version in enumerate(raw_versions(observed(spark, sf_dir))):
        headings = [c for c in version.columns if c not in PARTITION]
        line = F.to_csv(F.struct(*[named(c) for c in headings]), CSV)
        write = partial(zip_lines, target=qualified(spark, target), version=number, head=CSV["sep"].join(headings))
        zipped = version.select(*PARTITION, line.alias("line")).mapInPandas(write, "path string")
        zipped.agg(F.count("path")).collect()


@contextmanager
def zipped_text(folder: str, name: str) -> Iterator[Callable[[bytes], int]]:
    """Writes what it is given to the file `name` of a new archive."""
    store, inner = open_filesystem(folder)
    store.create_dir(inner, recursive=True)
    with store.open_output_stream(f"{inner}/{name}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("leia-me.txt", "fonte")
        with archive.open(f"dados/{name}", "w", force_zip64=True) as member:
            yield member.write


def zip_lines(batches: Iterator[pd.DataFrame], target: str, version: int, head: str) -> Iterator[pd.DataFrame]:
    """Zips the lines of each partition as they come. A task that is repeated writes the same archives anew."""
    name = f"{version}-{TaskContext.get().partitionId():05d}.csv"
    with ExitStack() as stack:
        archives = {}
        for batch in batches:
            for (ano, half), lines in batch.groupby(list(PARTITION))["line"]:
                folder = f"{target}/ano={ano}/semestre={half}"
                if folder not in archives:
                    archives[folder] = stack.enter_context(zipped_text(folder, name))
                    archives[folder](f"{head}\n".encode())
                archives[folder](("\n".join(lines) + "\n").encode())
    yield pd.DataFrame({"path": [f"{folder}/{name}.zip" for folder in archives]}, dtype="object")


def zip_of(members: dict[str, bytes]) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return packed.getvalue()


def zip_cases(batches: Iterator[pd.DataFrame], target: str, late: bool) -> Iterator[pd.DataFrame]:
    """An archive per file, in one of five states by its partition: no CSV, one, two, broken, one with another that comes late."""
    for batch in batches:
        paths = []
        for path, content, ano, half in batch.itertuples(index=False):
            case = (2 * ano + half) % 5
            members = [{}, {"a.csv": content}, {"a.csv": content, "b.CSV": content}, {}, {"a.csv": content}][case]
            packed = b"no archive, but long enough for one" if case == 3 else zip_of({"leia-me.txt": b"fonte"} | members)
            if late and case != 4:
                continue
            store, inner = open_filesystem(f"{target}/ano={ano}/semestre={half}")
            store.create_dir(inner, recursive=True)
            name = path.rsplit("/", 1)[-1].removesuffix(".csv")
            with store.open_output_stream(f"{inner}/{name}{'-tarde' if late else ''}.zip") as out:
                out.write(packed)
            paths.append(path)
        yield pd.DataFrame({"path": paths}, dtype="object")


@once
def landing_runs(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The manifests of two landings of archives in five states; the late ones arrive between them."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(bronze(spark, sf_dir))
        .select("path", "content", *PARTITION)
    )
    source, landing = f"{target}/zip", f"{target}/bronze"
    for run in (1, 2):
        cases = partial(zip_cases, target=qualified(spark, source), late=run == 2)
        with one_row_batches(spark):
            files.mapInPandas(cases, "path string").agg(F.count("path")).collect()
        manifest = land_archives(spark, source, landing)
        manifest.withColumn("rodada", F.lit(run)).write.mode("append").parquet(f"{target}/manifest")


_manifests: dict[str, DataFrame] = {}


@once
def landed(spark: SparkSession, sf_dir: str, target: str) -> None:
    _manifests[target] = land_archives(spark, archives(spark, sf_dir), target)


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifests[landed(spark, sf_dir)]


@once
def silver(spark: SparkSession, sf_dir: str, target: str) -> None:
    bronze_to_silver(spark, bronze(spark, sf_dir), target)


@once
def first_halves(spark: SparkSession, sf_dir: str, target: str) -> None:
    """A Silver folder still without the second semesters."""
    publish_silver(views.silver(observed(spark, sf_dir)).where("semestre = 1"), target)


@once
def direct_silver(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Silver of all semesters, published without the file job."""
    publish_silver(views.silver(observed(spark, sf_dir)), target)


@once
def payload(spark: SparkSession, sf_dir: str, target: str) -> None:
    """The municipality list as JSON arrays, one per region."""
    records = views.municipality_records(spark, sf_dir)
    region = F.col("`regiao-imediata`.`regiao-intermediaria`.UF.regiao.nome")
    arrays = records.groupBy(region).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(target)


@once
def dimension(spark: SparkSession, sf_dir: str, target: str) -> None:
    build_dimension(spark, payload(spark, sf_dir), target)


@once
def gold(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Gold as published by the whole chain from raw files."""
    silver_to_gold(spark, silver(spark, sf_dir), dimension(spark, sf_dir), target)


@once
def direct_gold(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Gold published straight from the typed tables; the analytical queries read it."""
    publish_gold(monthly_prices(views.enriched(observed(spark, sf_dir))), target)


@once
def doubtful_gold(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Published Gold with faults in it."""
    gold = spark.read.schema(GOLD).parquet(direct_gold(spark, sf_dir))
    publish_gold(views.doubtful(gold.select(GOLD.fieldNames())), target)


@once
def surplus_bronze(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Raw files of whole headers, some of whose lines have more fields than that, written as text.

    By quantity: 1, a field more; 2, an empty one more; 3, two delimiters inside quotes; 4, an unclosed quote
    before a delimiter; 5, two quotes within fields around a delimiter, which don't protect it; 6, bytes that
    are not UTF-8.
    """
    rows = views.observed_lines(observed(spark, sf_dir))
    head = ";".join(RAW_HEADINGS)
    by_partition = rows.groupBy(*PARTITION, "line_group").agg(F.collect_list("line").alias("lines"))
    texts = by_partition.select(
        *PARTITION, F.concat(F.lit(head + "\n").cast("binary"), F.unhex(F.array_join("lines", "0A")), F.lit("\n").cast("binary")).alias("content")
    )
    write = partial(write_texts, target=qualified(spark, target))
    texts.mapInPandas(write, "path string").agg(F.count("path")).collect()


def write_texts(batches: Iterator[pd.DataFrame], target: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        paths = []
        for ano, half, content in batch.itertuples(index=False):
            store, inner = open_filesystem(f"{target}/ano={ano}/semestre={half}")
            store.create_dir(inner, recursive=True)
            name = f"{inner}/{zlib.crc32(content):08x}-{len(content)}.csv"
            with store.open_output_stream(name) as out:
                out.write(content)
            paths.append(name)
        yield pd.DataFrame({"path": paths})
