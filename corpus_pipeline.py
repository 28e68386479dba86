"""Documents for training: without toxic ones, near copies, benchmark text and personal data, packed into bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm import decontamination, minhash_dedup, packing, personal_data, toxicity
from litro.llm.common import cut, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies here: five-word shingles and a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from this stage's texts and the labels, does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of least id; of rows with one id and text, one. Copies without id
    stay only where no row of their group has one."""
    gone = minhash_dedup.decisions(docs, PERCENT, SHINGLE).where("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    keyed = minhash_dedup.with_text_key(docs.select(*COLUMNS))
    kept = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left_anti")
    return kept.select(*COLUMNS).dropDuplicates(["doc_id", "text"])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item. Each row is judged by its own text: rows that share an id, or have none, too."""
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind; n_chars anew where the text changed."""
    others = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("was"), F.col("text").isNull().alias("none"), "lang", "source", "n_chars")
    clean = personal_data.redact(docs).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("now"), "redacted", F.size("spans").alias("n"))
    clean = clean.dropDuplicates(["id", "now"])
    both = others.join(clean, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("was") == F.col("now")))
    return both.select(
        "doc_id",
        F.when(~F.col("none"), F.col("redacted")).alias("text"),
        "lang",
        "source",
        F.when(F.col("n") > 0, F.length("redacted").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies."""
    return packing.best_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal),
    ("packing", pack),
]

#: SQL cannot express the learnt stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the checkpoint folder before the next."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
