"""How five filters interact: what each removes in every order, and its Shapley value.

Spark counts the documents of each part by the set of filters they fail: 32 counts at most, whatever the
size of the part. From them come the removals of all 32 coalitions of filters. Shapley values solve the
least-squares fit of the removals by sums of filter weights, weighted by the Shapley kernel and
constrained to the removal of the full coalition; the normal equations are solved in rationals. Differences
of coalitions give the counts of every step of every order.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import sized, table, words

FILTERS = "ABCDE"
FULL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS = 100
SYMBOLS = "#$%&*|"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails, judged on all of it."""
    tokens = words(text)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = [
        F.size(tokens) < LEAST_WORDS,
        100 * F.size(F.array_distinct(tokens)) < 80 * F.size(tokens),
        100 * capitals.cast("long") > 10 * F.length(text),
        F.length(F.translate(text, SYMBOLS, "")) < F.length(text),
    ]
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed)]
    return sum(bits[1:], bits[0])


def marked(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): numbers of documents by the filters they fail and by label.

    A text that many documents share is one row a task and label before it is shuffled. Which of its rows
    comes first is the least of the groups' least ids, so no group of copies meets as documents.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    name = F.coalesce(docs[part].cast("string"), F.lit(""))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), name.alias("part"), text.alias("text"))
    docs = docs.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"), failures(F.col("text")).alias("mask"))
    flag = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)).cast("int")).alias(c)
    labels = labels.where("doc_id IS NOT NULL").groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(flag("quality"), flag("toxic"))
    labels = labels.where("quality + toxic > 0")
    # Rows without id have no label; they don't meet in one task of the join.
    known = docs.where("doc_id IS NOT NULL").join(sized(labels), "doc_id", "left")
    unknown = docs.where("doc_id IS NULL").select("*", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    both = known.unionByName(unknown).na.fill(0, ["quality", "toxic"])
    group = ("key", "part", "mask", "quality", "toxic")
    rows = both.groupBy(*group, "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    with_id = F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")).otherwise(0)).alias("with_id")
    rows = rows.groupBy(*group).agg(F.sum("n").alias("n"), with_id, first)
    least = rows.groupBy("key").agg(F.min("first.doc_id").alias("least"))
    rows = rows.join(least, "key")
    later = F.col("with_id") - F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    split = F.explode(F.array(F.struct((F.col("mask") + copy).alias("mask"), later.alias("n")), F.struct(F.col("mask").alias("mask"), (F.col("n") - later).alias("n"))))
    rows = rows.select("part", "quality", "toxic", split.alias("x")).where("x.n > 0")
    return rows.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("quality")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")
    )


def removals(counts: list[int]) -> list[int]:
    """What each coalition removes: the documents that fail one of its filters or more. counts: by failed set."""
    return [sum(n for mask, n in enumerate(counts) if mask & coalition) for coalition in range(FULL + 1)]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of regular linear equations, exact."""
    rows = [[*row, value] for row, value in zip(matrix, right, strict=True)]
    for i in range(len(rows)):
        at = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                rows[k] = [a - rows[k][i] * b for a, b in zip(rows[k], rows[i], strict=True)]
    return [row[-1] for row in rows]


def shapley(removed: list[int]) -> list[Fraction]:
    """Minimises the kernel-weighted squares of removed[S] - sum of S's values, the sum of all values being removed[all].

    The last row and column hold the multiplier of the constraint.
    """
    m = (len(removed) - 1).bit_length()
    every = range(m)
    matrix = [[Fraction(0)] * (m + 1) for _ in range(m + 1)]
    right = [Fraction(0)] * m + [Fraction(removed[-1])]
    for coalition in range(1, len(removed) - 1):
        size = coalition.bit_count()
        weight = Fraction(m - 1, comb(m, size) * size * (m - size))
        inside = [i for i in every if coalition >> i & 1]
        for i in inside:
            right[i] += weight * removed[coalition]
            for j in inside:
                matrix[i][j] += weight
    for i in every:
        matrix[i][m] = matrix[m][i] = Fraction(1)
    if m == 1:  # no coalition but none and all
        return [Fraction(removed[-1])]
    return solve(matrix, right)[:m]


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def steps(counts: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """(filter_order, step, kept, …) of every order; each list is by failed set."""
    all_of, removed, good_removed, toxic_removed = sum(counts), removals(counts), removals(good), removals(toxic)
    values = [v * len(ORDERS) for v in shapley(removed)]
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            i = FILTERS.index(letter)
            own = 1 << i
            after = before | own
            here = removed[after] - removed[before]
            yield (
                order, step, all_of - removed[after], here, removed[own] - here, removed[FULL] - removed[FULL ^ own],
                good_removed[after] - good_removed[before], toxic_removed[after] - toxic_removed[before], int(values[i]),
            )
            before = after


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in STEPS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            tables = [[0] * (FULL + 1) for _ in range(3)]
            for x in row["counts"]:
                for values, key in zip(tables, ("n", "good", "toxic"), strict=True):
                    values[x["mask"]] += x[key]
            columns = zip(*steps(*tables), strict=True)
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(arrays[0])), *arrays], names)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """600 rows for each part: five steps of 120 orders of the filters A to E.

    Columns: part, filter_order, step, and numbers of documents: kept after this step, removed here,
    redundant (failing its filter but removed earlier), unique_fails (failing its filter only), good_lost and
    toxic_lost (removed here and labelled so), shapley (removed by its filter, added up over all orders).
    Nulls: a missing text and a missing part are empty; a document without id fails E never, makes no other one
    fail it, and has no label. Of several labels of an id one of 1 is enough. Repeated rows count each and, having
    one id, are no copies of each other. An empty table gives no rows. Other columns are ignored.
    """
    counts = marked(docs, labels, part)
    # 32 sets of failed filters in a part at most.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return parts.mapInArrow(_audit, STEPS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
label AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(tokens.doc_id) OVER (PARTITION BY text) < tokens.doc_id THEN 'E' ELSE '' END AS fails
  FROM tokens LEFT JOIN label ON tokens.doc_id = label.doc_id),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || letter FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS f(letter)
  WHERE NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (VALUES (1), (2), (3), (4), (5)) AS s(step) WHERE length(filter_order) = 5),
told AS (
  SELECT part, filter_order, step, letter,
    CASE WHEN earlier <> '' AND regexp_matches(fails, '[' || earlier || ']') THEN 1 ELSE 0 END AS gone,
    CASE WHEN contains(fails, letter) THEN 1 ELSE 0 END AS hit, CASE WHEN fails = letter THEN 1 ELSE 0 END AS only_hit, n, good, toxic
  FROM steps, counted),
summed AS (
  SELECT part, filter_order, step, letter,
    cast(sum(CASE WHEN gone = 0 AND hit = 0 THEN n ELSE 0 END) AS bigint) AS kept,
    cast(sum(CASE WHEN gone = 0 AND hit = 1 THEN n ELSE 0 END) AS bigint) AS removed,
    cast(sum(CASE WHEN gone = 1 AND hit = 1 THEN n ELSE 0 END) AS bigint) AS redundant,
    cast(sum(only_hit * n) AS bigint) AS unique_fails,
    cast(sum(CASE WHEN gone = 0 AND hit = 1 THEN good ELSE 0 END) AS bigint) AS good_lost,
    cast(sum(CASE WHEN gone = 0 AND hit = 1 THEN toxic ELSE 0 END) AS bigint) AS toxic_lost
  FROM told GROUP BY ALL)
SELECT part, filter_order, cast(step AS int) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) OVER (PARTITION BY part, letter) AS bigint) AS shapley FROM summed"""
