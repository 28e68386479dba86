"""Documents that contain benchmark text, by spaced-seed hashing. Native functions only.

Each mask looks at 6 of 8 or 9 neighbouring words and ignores the others. Hashes of the benchmark's
words under the masks are joined with those of every place in the documents; around a hit, document
and item are laid side by side and compared word for word. With these masks a hit is certain for
every overlap that counts: 13 places, the first equal, with 2 other words at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import id_and_text, sized, table, words

MASKS = ((0, 1, 3, 4, 5, 7), (0, 2, 5, 6, 7, 8))
#: An overlap: so many equal words within so many places.
EQUAL, PLACES = 11, 13
#: What is not part of a word.
MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_`~@^+=/\\"


def hashed_words(text: Column) -> Column:
    """Hashes of the lower-cased words without marks."""
    return F.transform(words(F.translate(F.lower(text), MARKS, "")), lambda w: F.xxhash64(w))


def _seeds(h: str) -> Column:
    """(key, at) under each mask at each place where the whole mask lies in the text."""

    def under(number: int, mask: tuple[int, ...]) -> Column:
        first = F.slice(h, 1, F.greatest(F.size(h) - mask[-1], F.lit(0)))
        key = lambda x, i: F.xxhash64(F.lit(number), x, *[F.get(h, i + k) for k in mask[1:]])
        return F.transform(first, lambda x, i: F.struct(key(x, i).alias("key"), i.alias("at")))

    return F.concat(*[under(number, mask) for number, mask in enumerate(MASKS)])


def row_key(docs: DataFrame) -> Column:
    """A number for id and text together, so that rows that share one of them are told apart; null is a value like any other."""
    return F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit("")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that overlap no item; each is judged by its own text, whatever its id."""
    found = overlaps(docs, benchmark).select("row_key").distinct()
    marked = docs.withColumn("_row_key", row_key(docs))
    return marked.join(found, marked["_row_key"] == found["row_key"], "left_anti").drop("_row_key")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_key, item_id, at, length): runs of a document's words, from `at`, that overlap an item; row_key is of id and text."""
    docs = id_and_text(docs)
    docs = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), hashed_words(F.col("text")).alias("h"))
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    items = items.distinct().select("item_id", hashed_words(F.coalesce("text", F.lit(""))).alias("item"))
    items = items.withColumn("item_key", F.xxhash64("item_id", "item"))
    item_seeds = items.select("item_key", _seeds("item").alias("seeds")).select("item_key", F.explode_outer("seeds").alias("s"))
    item_seeds = item_seeds.where("s IS NOT NULL").select("item_key", F.col("s.key").alias("key"), F.col("s.at").alias("item_at")).distinct()
    # The outer form: for the inner one the optimizer would test the arrays' size on every word.
    seeds = docs.select("row_key", _seeds("h").alias("seeds")).select("row_key", F.explode_outer("seeds").alias("s"))
    seeds = seeds.select("row_key", F.col("s.key").alias("key"), F.col("s.at").alias("at"))
    hits = seeds.join(sized(item_seeds), "key").select("row_key", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    side = hits.join(docs.dropDuplicates(["row_key"]), "row_key").join(items, "item_key")
    same = F.transform("item", lambda x, j: F.when((F.col("shift") + j >= 0) & (F.get("h", F.greatest(F.col("shift") + j, F.lit(0))) == x), 1).otherwise(0))
    side = side.select("row_key", "item_id", "shift", same.alias("same"))
    count = lambda j: F.aggregate(F.slice("same", j + 1, PLACES), F.lit(0), lambda a, b: a + b)
    starts = F.filter(F.transform("same", lambda x, j: F.when((x == 1) & (count(j) >= EQUAL), j)), lambda j: j.isNotNull())
    side = side.select("row_key", "item_id", "shift", "same", starts.alias("starts"))
    runs = side.select("row_key", "item_id", "shift", "same", F.explode("starts").alias("start"))
    # Equal words of all qualifying windows; places covered by one of them.
    return runs.select(
        "row_key",
        "item_id",
        F.filter(
            F.transform(F.slice("same", F.col("start") + 1, PLACES), lambda x, k: F.when(x == 1, F.col("shift") + F.col("start") + k)),
            lambda k: k.isNotNull(),
        ).alias("places"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, n_words, items array), a row for each row of docs.

    A document is contaminated if some item, laid beside it, has 11 equal words within 13 places that
    begin with an equal one. n_words counts the document's equal words in all such windows, items
    are the ids. Words are lower-cased, without marks. Items of fewer than 11 words cannot be found.
    Nulls: a missing text has no words; a missing doc_id or item_id is kept as null (a null item is
    not counted in n_items). Repeated rows get equal results, repeated items count once. An empty
    table of documents gives no rows, an empty benchmark no contamination. Other columns are ignored.
    """
    found = overlaps(docs, benchmark)
    # Windows of one document become distinct places before they meet.
    places = found.select("row_key", F.explode("places").alias("place")).distinct().groupBy("row_key").agg(F.count("*").alias("n_words"))
    items = found.select("row_key", "item_id").distinct().groupBy("row_key").agg(
        F.count("item_id").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items")
    )
    verdict = places.join(items, "row_key")
    keyed = id_and_text(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"))
    result = keyed.join(verdict, "row_key", "left")
    zero = F.lit(0).cast("long")
    return result.select(
        "doc_id",
        F.col("n_words").isNotNull().alias("contaminated"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("n_words", zero).alias("n_words"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return result.withColumn("items", F.array_join("items", ","))


def _sql_words(table_name: str, key: str, marks: str) -> str:
    text = f"translate(lower(coalesce(text, '')), '{marks}', '')"
    split = f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM (SELECT {key}, {split} AS w FROM {table_name})"


_MARKS = MARKS.replace("'", "''")
ORACLE = f"""
WITH d AS ({_sql_words("documents", "doc_id", _MARKS)}),
b AS ({_sql_words("benchmark", "item_id", _MARKS)}),
same AS (SELECT doc_id, item_id, d.pos - b.pos AS shift, d.pos AS pos FROM d JOIN b USING (word)),
busy AS (SELECT doc_id, item_id, shift FROM same GROUP BY ALL HAVING count(*) >= {EQUAL}),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos RANGE BETWEEN CURRENT ROW AND {PLACES - 1} FOLLOWING) AS n
  FROM same JOIN busy USING (doc_id, item_id, shift)),
hit AS (
  SELECT *, max(CASE WHEN n >= {EQUAL} THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos RANGE BETWEEN {PLACES - 1} PRECEDING AND CURRENT ROW) AS inside FROM counted),
verdict AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, count(DISTINCT pos) AS n_words,
    list_sort(list(DISTINCT item_id)) AS items
  FROM hit WHERE inside = 1 GROUP BY doc_id)
SELECT doc_id, n_words IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(n_words, 0) AS n_words,
  coalesce(array_to_string(items, ','), '') AS items
FROM documents LEFT JOIN verdict USING (doc_id)
"""
