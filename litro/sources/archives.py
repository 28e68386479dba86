"""Landing of ZIP archives: exactly one CSV member each, extracted next to its partition folder.

What has landed is kept as a table below the Bronze folder, keyed by the archive's path and a check sum of
its directory, so an archive lands once, one that comes late or anew lands then, and a run that died is
taken up again: rows are written before files land (`planejado`) and after (`landado`).
"""

from __future__ import annotations

import shutil
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.schemas import PARTITION
from litro.session import scratch_folder, stage, work_folder
from litro.sources.files import has_files, partition_metadata
from litro.sources.remote import exists, open_filesystem, qualified

#: The committed table lies in this folder of Bronze; readers skip names that start with an underscore.
COMMITTED = "_manifesto"
PLANNED, LANDED = "planejado", "landado"
COMMIT = "path string, crc bigint, ano int, semestre int, destino string, bytes bigint, estado string"
MANIFEST = (
    "path string, ano int, semestre int, crc bigint, membros_csv int, destino string, bytes bigint, erro string"
)

#: Archives are dealt over so many tasks at most.
MOST_TASKS = 10_000
#: Bytes of the record that ends every archive, by the format.
END_RECORD = 22


def _crc(store, path: str) -> int:
    value = 0
    with store.open_input_stream(path) as stream:
        while block := stream.read(1 << 20):
            value = zlib.crc32(block, value)
    return value


def directory(path: str) -> tuple[int | None, int, str | None, int | None, str | None]:
    """(check sum of the archive's directory, CSV members, name of the only one, its bytes, error).

    Only the end of the archive is read. The sum covers names, sizes and check sums of all members.
    """
    store, inner = open_filesystem(path)
    with store.open_input_file(inner) as raw:
        if raw.size() < END_RECORD:  # too short for the record that ends every archive
            return None, 0, None, None, "File is not a zip file"
        try:
            listed = zipfile.ZipFile(raw).infolist()
        except zipfile.BadZipFile as problem:
            return None, 0, None, None, str(problem)
    crc = zlib.crc32(repr(sorted((m.filename, m.file_size, m.CRC) for m in listed)).encode())
    members = [m for m in listed if m.filename.lower().endswith(".csv")]
    if len(members) != 1:
        names = sorted(m.filename for m in members)
        return crc, len(members), None, None, f"expected exactly 1 CSV, found {names}"
    return crc, 1, members[0].filename, members[0].file_size, None


def read_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = pd.DataFrame(
            [directory(p) for p in batch["path"]], columns=["crc", "membros_csv", "membro", "bytes", "erro"]
        )
        kept = batch[["path", *PARTITION]].reset_index(drop=True)
        yield pd.concat([kept, found.astype({"crc": "Int64", "bytes": "Int64"})], axis=1)


DIRECTORIES = (
    "path string, ano int, semestre int, crc bigint, membros_csv int, membro string, bytes bigint, erro string"
)


def extract(path: str, member: str, target: str, replaced: list[str]) -> None:
    """Writes a member of an archive to `target`, then deletes what the archive landed as before.

    The archive is read where it lies, a block at a time. The file is written under a hidden name and moved,
    so a lost or repeated task leaves no partial file.
    """
    store, inner = open_filesystem(path)
    with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
        store, inner = open_filesystem(target)
        folder, name = inner.rsplit("/", 1)
        store.create_dir(folder, recursive=True)
        hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
        crc = archive.getinfo(member).CRC
        try:
            with archive.open(member) as source, store.open_output_stream(hidden) as out:
                shutil.copyfileobj(source, out, 1 << 20)
        except BaseException:
            store.delete_file(hidden)
            raise
    try:
        store.move(hidden, inner)
    except OSError:
        # Some stores refuse to replace a file: fine if a first attempt already landed the same bytes.
        store.delete_file(hidden)
        if _crc(store, inner) != crc:
            raise
    for old in replaced:
        store, inner = open_filesystem(old)
        if store.get_file_info(inner).is_file:
            store.delete_file(inner)


def land_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Extracts each row's archive; a member that cannot be read is that row's error."""
    for batch in batches:
        problems = []
        for path, member, target, replaced in zip(batch["path"], batch["membro"], batch["destino"], batch["antes"], strict=True):
            try:
                extract(path, member, target, list(replaced))
                problems.append(None)
            except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as problem:
                problems.append(f"{type(problem).__name__}: {problem}")
        yield batch.drop(columns=["membro", "antes"]).assign(erro=problems)


def committed(spark: SparkSession, bronze: str) -> DataFrame:
    """path, crc, ano, semestre, destino, bytes, estado of all that was planned and landed so far."""
    folder = f"{bronze.rstrip('/')}/{COMMITTED}"
    if not exists(spark, folder):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(folder)


def foreign_partitions(spark: SparkSession, bronze: str, known: DataFrame) -> DataFrame:
    """Partitions of Bronze with a CSV that came from no archive."""
    if not has_files(spark, bronze, "*.csv"):
        return spark.createDataFrame([], "ano int, semestre int")
    files = partition_metadata(spark, bronze, "*.csv")
    return files.join(known.select(F.col("destino").alias("path")), "path", "left_anti").select(*PARTITION).distinct()


def land_archives(spark: SparkSession, archives: str, bronze: str) -> DataFrame:
    """Extracts `archives/ano=/semestre=/*.zip` into the Bronze layout; returns the manifest of this run.

    An archive whose path and directory are committed as landed is left alone. Partitions that hold a CSV of
    another origin are skipped. Of several archives in a partition each lands under a name that starts with
    the archive's; one that changed replaces what it landed before. Directories are read and archives
    unpacked in tasks, one at a time; archives without exactly one CSV, or unreadable, come back with `erro`
    set, land nothing and are tried again. One landing at a time.
    """
    files = partition_metadata(spark, archives, "*.zip")
    tasks = min(MOST_TASKS, max(1, files.count()))
    known = committed(spark, bronze)
    with scratch_folder(spark, "landing") as work:
        listed = files.select("path", *PARTITION).repartition(tasks, "path").mapInPandas(read_directories, DIRECTORIES)
        listed = stage(listed, f"{work}/directories")
        done = known.where(F.col("estado") == LANDED).select("path", "crc").distinct()
        todo = listed.join(done, ["path", "crc"], "left_anti")
        todo = todo.join(foreign_partitions(spark, bronze, known), list(PARTITION), "left_anti")
        others = listed.select("path", *PARTITION).union(known.select("path", *PARTITION)).distinct()
        todo = todo.join(others.groupBy(*PARTITION).agg((F.count(F.lit(1)) > 1).alias("dividida")), list(PARTITION))
        # The scan looks for `.csv`: another spelling of the extension would never be read.
        name = F.concat(F.regexp_replace(F.regexp_extract("membro", "([^/]*)$", 1), "(?i)[.]csv$", ""), F.lit(".csv"))
        origin = F.concat(F.regexp_extract("path", "([^/]*?)(?:[.][^./]*)?$", 1), F.lit("__"))
        folder = F.concat(F.lit(f"{qualified(spark, bronze).rstrip('/')}/ano="), "ano", F.lit("/semestre="), "semestre")
        target = F.concat(folder, F.lit("/"), F.when(F.col("dividida"), origin).otherwise(""), name)
        todo = stage(todo.withColumn("destino", F.when(F.col("erro").isNull(), target)), f"{work}/todo")
        ready = todo.where("erro IS NULL")
        _commit(ready, bronze, PLANNED)
        before = known.groupBy("path").agg(F.collect_set("destino").alias("antes"))
        ready = ready.join(before, "path", "left").withColumn(
            "antes", F.array_except(F.coalesce("antes", F.array().cast("array<string>")), F.array("destino"))
        )
        columns = [c.split()[0] for c in MANIFEST.split(", ")]
        to_land = ready.select("path", *PARTITION, "crc", "membros_csv", "destino", "bytes", "erro", "membro", "antes")
        run = to_land.repartition(tasks, "path").mapInPandas(land_batches, MANIFEST)
        landed = stage(run, f"{work}/landed")
        _commit(landed.where("erro IS NULL"), bronze, LANDED)
        failed = todo.where("erro IS NOT NULL").unionByName(landed.where("erro IS NOT NULL"), allowMissingColumns=True)
        nothing = {"destino": F.lit(None).cast("string"), "bytes": F.lit(None).cast("bigint")}
        manifest = landed.where("erro IS NULL").unionByName(failed.withColumns(nothing).select(*columns))
        return stage(manifest.select(*columns), work_folder(spark, "manifest"))


def _commit(rows: DataFrame, bronze: str, state: str) -> None:
    rows = rows.select("path", "crc", *PARTITION, "destino", "bytes", F.lit(state).alias("estado"))
    rows.hint("rebalance").write.mode("append").parquet(f"{bronze.rstrip('/')}/{COMMITTED}")
