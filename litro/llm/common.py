"""Helpers that several operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, and the words themselves, as Java regular expressions.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Ids that are missing sort after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(frame: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id long, text string); a missing text is empty. Other columns cannot clash."""
    return frame.select(
        frame[id_column].cast("long").alias("doc_id"),
        F.coalesce(frame[text].cast("string"), F.lit("")).alias("text"),
    )


def words(text: Column) -> Column:
    """The words of a text; an empty array where there is none."""
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def total_bytes(frame: DataFrame, text: str = "text") -> int:
    return frame.agg(F.sum(F.octet_length(text))).first()[0] or 0


def cut(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    context = frame.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        shared = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return frame.checkpoint()


#: Rows of a few numbers that may be sent to every executor: 64 MB or less.
SMALL_ROWS = 2_000_000


def sized(frame: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """Marked for broadcast if a count shows that it is small enough; else joins shuffle it."""
    return F.broadcast(frame) if frame.limit(most + 1).count() <= most else frame
