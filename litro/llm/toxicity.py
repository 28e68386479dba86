"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is fitted in numpy from texts confirmed as toxic and
from texts whose label is not read. The risk is corrected by the class prior p: p times the loss of
the confirmed as positives, plus the loss of the unlabelled as negatives less p times that of the
confirmed as negatives, the latter two together never below zero (when they are, their gradient is turned).

All texts that are not held out are counted and fitted on. Texts that show the same of the classifier's
features are one row with a number, so the fit reads a table of patterns and not of texts.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import cut, sized, table

#: Words and their first letters, so many of them, are hashed to so many features.
BEGINNINGS = (4, 5)
FEATURES = 1 << 22
#: What surrounds a word and is not part of it.
MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"
#: Only features of so many confirmed texts or more are counted in the unlabelled ones.
LEAST_CONFIRMED = 3
#: So many patterns are fitted on the driver; of more each round adds up its sums in tasks.
MOST_PATTERNS = 200_000
#: Features that enter the classifier: by the prior, texts that have them are toxic with this probability
#: at least, and their share among the confirmed is this many standard deviations above the unlabelled's. The classifier
#: has so many weights at most, of the features that deviate most.
LEAST_POSTERIOR = 0.4
LEAST_DEVIATION = 4.0
MOST_FEATURES = 512
ROUNDS = 200


#: Words whose features a task remembers, and distinct words of texts that are looked up at once.
REMEMBERED, AT_ONCE = 1 << 19, 1 << 18


def _number(part: str) -> int:
    return xxhash.xxh3_64_intdigest(part.encode()) % FEATURES


class _Words(dict):
    """Numbers of the words met so far; flat has the features of each, -1 where there are fewer."""

    def __init__(self):
        super().__init__()
        self.flat = array("q")

    def __missing__(self, word: str) -> int:
        bare = word.strip(MARKS)
        self.flat.append(_number(f"0{bare}") if bare else -1)
        for n in BEGINNINGS:
            self.flat.append(_number(f"{n}{bare[:n]}") if len(bare) >= n else -1)
        at = self[word] = len(self)
        return at

    def table(self) -> np.ndarray:
        return np.array(self.flat, np.int64).reshape(-1, 1 + len(BEGINNINGS))

    def clear(self) -> None:
        super().clear()
        self.flat = array("q")


_WORDS = _Words()


def shown(texts: Iterable[str | None], chosen: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each run of texts: their number, and (text, feature) pairs, distinct and sorted, texts counted from 0.

    Each text is read whole. chosen: which of all features count, by number.
    """
    sizes: list[int] = []
    words: list[int] = []

    def run() -> tuple[int, np.ndarray, np.ndarray]:
        found = _WORDS.table()[np.array(words, np.int64)]
        text = np.repeat(np.arange(len(sizes)), sizes)[:, None] * FEATURES
        wanted = found >= 0 if chosen is None else (found >= 0) & chosen[found]
        pairs = np.sort((text + found)[wanted])
        pairs = pairs[np.diff(pairs, prepend=-1) > 0]
        return len(sizes), pairs // FEATURES, pairs % FEATURES

    for text in texts:
        distinct = set((text or "").lower().split())
        words.extend(map(_WORDS.__getitem__, distinct))
        sizes.append(len(distinct))
        if len(words) >= AT_ONCE:
            yield run()
            sizes, words = [], []
            if len(_WORDS) > REMEMBERED:
                _WORDS.clear()
    if sizes:
        yield run()


def _flags(numbers: Iterable[int]) -> np.ndarray:
    flags = np.zeros(FEATURES, bool)
    flags[list(numbers)] = True
    return flags


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def margins(self, texts: Iterable[str | None]) -> np.ndarray:
        flags = _flags(self.features)
        parts = [np.bincount(text, self.weights[np.searchsorted(self.features, f)], n) for n, text, f in shown(texts, flags)]
        return np.concatenate([np.zeros(0), *parts]) + self.bias


@dataclass
class Patterns:
    """Rows of 0 and 1, sparse: feature[k] is shown by row[k]; n texts are such a row, confirmed or not."""

    row: np.ndarray
    feature: np.ndarray
    positive: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, shown: list[list[int]], positive: list[bool], n: list[int]) -> Patterns:
        sizes = [len(s) for s in shown]
        flat = np.fromiter((f for s in shown for f in s), np.int64, sum(sizes))
        return cls(np.repeat(np.arange(len(shown)), sizes), flat, np.array(positive, bool), np.array(n, float))

    def sums(self, w: np.ndarray, bias: float) -> np.ndarray:
        """Losses as negatives of the unlabelled and the confirmed, then three gradients by weight and bias: of
        the confirmed as positives, of them as negatives, and of the unlabelled as negatives."""
        z = np.bincount(self.row, w[self.feature], len(self.n)) + bias
        up, down = -1 / (1 + np.exp(np.clip(z, -30, 30))), 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = np.logaddexp(0, z) * self.n
        out = [np.array([loss[~self.positive].sum(), loss[self.positive].sum()])]
        for slope, rows in ((up, self.positive), (down, self.positive), (down, ~self.positive)):
            g = slope * self.n * rows
            out += [np.bincount(self.feature, g[self.row], len(w)), np.array([g.sum()])]
        return np.concatenate(out)


def minimise(sums: Callable[[np.ndarray, float], np.ndarray], size: int, n_p: float, n_u: float, prior: float, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier of least non-negative risk; sums as Patterns gives them, over all rows."""
    w, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        found = sums(w, bias)
        up_p, down_p, down_u = found[2:].reshape(3, size + 1)
        negative = found[0] / n_u - prior * found[1] / n_p
        g = down_u / n_u - prior * down_p / n_p
        g = -g if negative < 0 else g + prior * up_p / n_p
        step = g + 1e-4 * np.r_[w, 0]
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def non_negative_pu(x: np.ndarray, positive: np.ndarray, prior: float, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """The same for rows of 0 and 1 in memory; positive: which rows are confirmed."""
    rows = Patterns.of([np.flatnonzero(r).tolist() for r in x], positive.tolist(), [1] * len(x))
    return minimise(rows.sums, x.shape[1], max(1, positive.sum()), max(1, (~positive).sum()), prior, rounds)


def _counted(numbers: list[int] | None):
    """For mapInArrow: (feature, p, u), numbers of confirmed and of other texts of a task that show it; of all features or those numbered."""

    def run(batches):
        counts = np.zeros((2, FEATURES), np.int64)
        chosen = None if numbers is None else _flags(numbers)
        for batch in batches:
            positive, at = batch["positive"].to_numpy(zero_copy_only=False).astype(np.int64), 0
            for n, text, feature in shown((t.as_py() for t in batch["text"]), chosen):
                np.add.at(counts, (positive[at + text], feature), 1)
                at += n
        keys = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts[1, keys]), pa.array(counts[0, keys])], ["feature", "p", "u"])

    return run


def _patterns(best: np.ndarray):
    """For mapInArrow: (positive, shown, n), the places of the best features that n texts of a task show."""

    def run(batches):
        counts: Counter = Counter()
        chosen = _flags(best)

        def flush():
            keys = list(counts)
            columns = [pa.array([k[0] for k in keys], pa.bool_()), pa.array([list(k[1]) for k in keys], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([counts[k] for k in keys], pa.int64())], ["positive", "shown", "n"])
            counts.clear()

        for batch in batches:
            positive = iter(batch["positive"].to_pylist())
            for n, text, feature in shown((t.as_py() for t in batch["text"]), chosen):
                ends = np.searchsorted(text, np.arange(n + 1))
                places = np.searchsorted(best, feature).tolist()
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    counts[next(positive), tuple(places[a:b])] += 1
            if len(counts) > 1 << 16:
                yield from flush()
        yield from flush()

    return run


def _sums_in_tasks(patterns: DataFrame, size: int) -> Callable[[np.ndarray, float], np.ndarray]:
    """Patterns.sums over a table, a job each time; the driver gets the sums by place."""

    def sums(w: np.ndarray, bias: float) -> np.ndarray:
        def run(batches):
            total = np.zeros(2 + 3 * (size + 1))
            for batch in batches:
                total += Patterns.of(batch["shown"].to_pylist(), batch["positive"].to_pylist(), batch["n"].to_pylist()).sums(w, bias)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "v"])

        found = patterns.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(2 + 3 * (size + 1))
        for r in found:
            out[r["at"]] = r.v
        return out

    return sums


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from rows of labels whose crc32 of the id as text, modulo 5, is not 0.

    The prior is the share of toxic among them. The unlabelled are texts of other ids that are not
    held out, whatever their label. All of them are read. Without a confirmed text the model is the prior alone.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    docs = docs.where("doc_id IS NOT NULL AND pmod(crc32(cast(doc_id AS string)), 5) <> 0")
    labels = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    labels = labels.where("toxic IN (0, 1) AND pmod(crc32(cast(doc_id AS string)), 5) <> 0").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = labels.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(0.5, max(0.01, (toxic or 0) / max(1, n)))
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    confirmed = labels.where("toxic = 1").select("doc_id", F.lit(True).alias("positive"))
    texts = docs.join(sized(confirmed), "doc_id", "left").select("text", F.coalesce("positive", F.lit(False)).alias("positive"))
    counts = dict(texts.groupBy("positive").count().collect())
    n_p, n_u = counts.get(True, 0), counts.get(False, 0)
    if not n_p or not n_u:
        return nothing
    # First the confirmed texts alone, then in all others only what enough of these show.
    counted = "feature long, p long, u long"
    own = docs.join(sized(confirmed), "doc_id").select("text", "positive").mapInArrow(_counted(None), counted)
    own = own.groupBy("feature").agg(F.sum("p").alias("p")).where(F.col("p") >= LEAST_CONFIRMED)
    likely = [r.feature for r in own.collect()]  # FEATURES numbers at most
    spread = texts.mapInArrow(_counted(likely), counted).groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    both = (F.col("p") + F.col("u")) / (n_p + n_u)
    deviation = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    posterior = prior * (F.col("p") / n_p) / ((F.col("u") + 1) / n_u)
    best = spread.where(posterior >= LEAST_POSTERIOR).select("feature", deviation.alias("z"))
    best = best.where(F.col("z") > LEAST_DEVIATION)
    best = np.sort([r.feature for r in best.orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).collect()]).astype(np.int64)
    if not len(best):
        return nothing
    patterns = texts.mapInArrow(_patterns(best), "positive boolean, shown array<int>, n long")
    patterns = cut(patterns.groupBy("positive", "shown").agg(F.sum("n").alias("n")))
    if patterns.count() <= MOST_PATTERNS:
        rows = sorted((r.positive, r.shown, r.n) for r in patterns.collect())
        sums = Patterns.of([r[1] for r in rows], [r[0] for r in rows], [r[2] for r in rows]).sums
    else:
        sums = _sums_in_tasks(patterns, len(best))
    return Model(best, *minimise(sums, len(best), n_p, n_u, prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `score`, 0 to 1, higher where the text is likelier toxic; each text is read whole. A missing text is empty."""
    blank = F.coalesce(docs["text"].cast("string"), F.lit(""))

    @F.pandas_udf("double")
    def probability(texts):
        return texts.__class__(1 / (1 + np.exp(-np.clip(model.margins(texts), -500, 500))), dtype="float64")

    return docs.withColumn("score", probability(blank))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of docs.

    Nulls: a missing text is empty and gets the score of no features; a row without doc_id counts as
    not held out, and is not learnt from. Labels that are null or not 0 or 1 are skipped; of several
    labels of a document the largest counts. Repeated rows get equal scores. An empty table gives no
    rows; empty labels give every document the least prior. Other columns are ignored.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    scored = score(docs, fit(docs, labels))
    held = F.coalesce(F.expr("pmod(crc32(cast(doc_id AS string)), 5) = 0"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
