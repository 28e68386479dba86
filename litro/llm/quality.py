"""Quality of documents: rules, and a hashed n-gram log-likelihood ratio. Native functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import sized, table, words

#: N-grams of these lengths fall into so many buckets.
ORDERS = (1, 2)
BUCKETS = 1 << 16
#: Added to each bucket's count in both multinomials.
SMOOTHING = 1.0
#: A document stays if its ratio a n-gram, in nats, is at least this.
THRESHOLD = -0.2
WINDOW = 5
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _parts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    return docs.select("doc_id", "text", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))


def _buckets(h: str = "h") -> Column:
    """The bucket of every n-gram of the hashed words."""

    def order(n: int) -> Column:
        first = F.slice(h, 1, F.greatest(F.size(h) - (n - 1), F.lit(0)))
        gram = lambda x, i: F.xxhash64(F.lit(n), x, *[F.get(h, i + k) for k in range(1, n)])
        return F.transform(first, lambda x, i: F.pmod(gram(x, i), F.lit(BUCKETS)).cast("int"))

    return F.concat(*[order(n) for n in ORDERS])


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); h are the hashed words."""
    parts = _parts(docs)
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    counted = parts.select(
        "doc_id",
        "h",
        F.size("h").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    windows = F.transform(
        F.slice("h", 1, F.greatest(F.size("h") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, *[F.get("h", i + k) for k in range(1, WINDOW)]).alias("x"), i.alias("i")),
    )
    counted = counted.select("*", F.sort_array(windows).alias("sorted")).select(
        "doc_id", "h", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(
            F.filter(
                F.transform("sorted", lambda p, j: F.when((F.get("sorted", j - 1)["x"] == p["x"]) | (F.get("sorted", j + 1)["x"] == p["x"]), p["i"])),
                lambda i: i.isNotNull(),
            )
        ).alias("at"),
    )
    # Each repeated window adds the words up to the next one, five at most.
    new = F.transform("at", lambda i, j: F.least(F.coalesce(F.get("at", j + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
    repeat = F.aggregate(new, F.lit(0), lambda a, b: a + b).cast("long")
    return counted.select("doc_id", "h", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"))


def ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: `weights`, the log-likelihood ratio of each bucket, from n-gram counts over all rows.

    trusted has the doc_id of texts that show the target; the raw corpus is all of docs.
    """
    ids = trusted.select(trusted["doc_id"].cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    marked = _parts(docs).select("doc_id", _buckets().alias("grams"))
    marked = marked.join(sized(ids.withColumn("target", F.lit(True))), "doc_id", "left")
    # The outer form: for the inner one the optimizer would test the arrays' size on every word of the text.
    grams = marked.select(F.col("target").isNotNull().cast("long").alias("target"), F.explode_outer("grams").alias("bucket"))
    grams = grams.where("bucket IS NOT NULL")
    counts = grams.groupBy("bucket").agg(F.sum("target").alias("t"), F.count("*").alias("r"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    row = every.agg(
        F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("r", F.lit(0)).alias("r")))).alias("c"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("t"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("r"),
    )
    share = lambda n, total: F.log((n + SMOOTHING) / (total + SMOOTHING * BUCKETS))
    return row.select(F.transform("c", lambda x: share(x["t"], F.col("t")) - share(x["r"], F.col("r"))).alias("weights"))


def quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept) for each row of docs.

    ratio is the mean log-likelihood ratio of the document's n-grams between the trusted texts and
    the whole corpus, 0 for a text without words; kept is false if base_failed, else ratio >= threshold.
    Nulls: a missing text has no words (and fails the base rules); a row without doc_id is never
    trusted. Repeated rows count each. Without trusted texts all ratios are computed from an even
    target. An empty table gives no rows. Other columns are ignored.
    """
    weights = ratios(docs, trusted).scalar()
    base = base_counts(docs).withColumn("grams", _buckets()).withColumn("weights", weights)
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get("weights", g))
    ratio = F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    result = base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), ratio.alias("ratio"))
    return result.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality(table(spark, sf_dir, "documents"), labels.where("quality = 1"))
