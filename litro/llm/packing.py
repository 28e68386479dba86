"""Best-fit packing of documents into bins of fixed length, under conflicts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm import minhash_dedup
from litro.llm.common import cut, table, words

#: Words of a bin.
CAPACITY = 2048
#: Pieces that are packed together; more of them are dealt over more groups.
GROUP_PIECES = 20_000
#: Near copies of op8: five-word shingles and a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


class Bins:
    """Open bins in the order of their free length, with bitmaps of the sources and clusters they hold."""

    def __init__(self, capacity: int, sources: int, clusters: int, most: int):
        self.capacity, self.count = capacity, 0
        self.free = np.zeros(0, np.int64)
        self.at = np.zeros(0, np.int64)
        self.sources = np.zeros((most, sources // 64 + 1), np.uint64)
        self.clusters = np.zeros((most, clusters // 64 + 1), np.uint64)

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the offset: the tightest bin that has room and no conflict, or a new one. -1 never conflicts."""
        i, step = int(np.searchsorted(self.free, length)), 8
        while i < len(self.free):
            bins = self.at[i : i + step]
            clash = self._has(self.sources, bins, source) | self._has(self.clusters, bins, cluster)
            if not clash.all():
                i += int(np.argmin(clash))
                chosen, free = int(self.at[i]), int(self.free[i])
                self.free, self.at = np.delete(self.free, i), np.delete(self.at, i)
                break
            i, step = i + step, step * 2
        else:
            chosen, free = self.count, self.capacity
            self.count += 1
        for maps, value in ((self.sources, source), (self.clusters, cluster)):
            if value >= 0:
                maps[chosen, value >> 6] |= np.uint64(1 << (value & 63))
        rest = free - length
        if rest:
            k = int(np.searchsorted(self.free, rest, "right"))
            self.free, self.at = np.insert(self.free, k, rest), np.insert(self.at, k, chosen)
        return chosen, self.capacity - free

    @staticmethod
    def _has(maps: np.ndarray, bins: np.ndarray, value: int) -> np.ndarray:
        if value < 0:
            return np.zeros(len(bins), bool)
        return (maps[bins, value >> 6] >> np.uint64(value & 63)) & np.uint64(1) > 0


def _numbers(values: list, least: int) -> tuple[np.ndarray, int]:
    """0, 1, … for each value that occurs `least` times or more, -1 for the others and for None."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    number = {v: k for k, v in enumerate(v for v, n in count.items() if n >= least and v is not None)}
    return np.array([number.get(v, -1) for v in values], np.int64), len(number)


PACKED = "doc_id long, part long, start long, length long, bin_id long, bin_offset long, source string"


def _pack(capacity: int):
    def run(key, group):
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("part", "ascending"), ("exact", "ascending"), ("cluster", "ascending")])
        sources, n_sources = _numbers(group["source"].to_pylist(), 2)
        clusters, n_clusters = _numbers(group["cluster"].to_pylist(), 2)
        bins = Bins(capacity, n_sources, n_clusters, group.num_rows)
        placed = [bins.place(*x) for x in zip(group["length"].to_pylist(), sources.tolist(), clusters.tolist(), strict=True)]
        base = key[0].as_py() << 32
        columns = {k: group[k] for k in ("doc_id", "part", "start", "length")}
        columns["bin_id"] = pa.array([base + b for b, _ in placed], pa.int64())
        columns["bin_offset"] = pa.array([o for _, o in placed], pa.int64())
        return pa.table(columns | {"source": group["source"]})

    return run


def best_fit(docs: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, cluster: str | None = None) -> DataFrame:
    """(doc_id, part, start, length, bin_id, bin_offset, source): where each piece of each document lies.

    docs has doc_id, text and source. A document of more than `capacity` words is cut into pieces of
    that many and a rest. The longest pieces are placed first, each in the fullest bin that has room
    and holds no piece of its source or of its duplicate cluster; such a bin is looked for until all open bins are tried. Pieces are dealt by hash over groups of
    about `group_pieces`, which are packed on their own, so neither a source nor a cluster meets in one task.
    The duplicate cluster is the number in the column that `cluster` names; without one, and where it is
    null, a text's own words, regardless of case, so that only exact copies conflict.
    Nulls: a missing text and a text without words give one piece of length 0 with no bin; a missing
    source never conflicts; a missing doc_id stays null. Equal lengths go by doc_id, part and
    words. Repeated rows are placed each, in different bins. An empty table gives no rows.
    """
    return pack_measured(measured(docs, cluster), capacity, group_pieces)


def measured(docs: DataFrame, cluster: str | None = None) -> DataFrame:
    """(doc_id, source, n, exact, cluster): number and hash of a text's words; what packing needs of it."""
    named = (docs[cluster] if cluster else F.lit(None)).cast("long").alias("cluster")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["source"].cast("string").alias("source"), named)
    tokens = words(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "source", F.size(tokens).cast("long").alias("n"), F.xxhash64(F.lower(F.array_join(tokens, " "))).alias("exact"), "cluster")


def pack_measured(docs: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """`best_fit` of what `measured` gives; no text is shuffled. Pieces are written once, as they are counted before they are dealt."""
    docs = docs.withColumn("cluster", F.coalesce("cluster", "exact"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / capacity) - 1)
    pieces = docs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part"))
    start = F.col("part") * capacity
    pieces = pieces.select("doc_id", "part", start.alias("start"), F.least(F.col("n") - start, F.lit(capacity)).alias("length"), "source", "exact", "cluster")
    pieces = cut(pieces)
    empty = pieces.where("length = 0").select("doc_id", "part", "start", "length", F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("bin_offset"), "source")
    full = pieces.where("length > 0")
    groups = max(1, -(-full.count() // group_pieces))
    dealt = full.withColumn("deal", F.pmod(F.xxhash64("doc_id", "part", "exact"), F.lit(groups)))
    packed = dealt.repartition(groups, "deal").groupBy("deal").applyInArrow(_pack(capacity), PACKED)
    return packed.unionByName(empty)


def assemble(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """(bin_id, text): the pieces of each bin in order, a blank line between them. A bin is no longer than its capacity."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), words(F.coalesce(docs["text"], F.lit(""))).alias("words"))
    pieces = placed.where("bin_id IS NOT NULL").join(texts, "doc_id")
    text = F.array_join(F.slice("words", F.col("start").cast("int") + 1, F.col("length").cast("int")), " ")
    bins = pieces.groupBy("bin_id").agg(F.sort_array(F.collect_list(F.struct("bin_offset", text.alias("text")))).alias("parts"))
    return bins.select("bin_id", F.array_join(F.col("parts.text"), "\n\n").alias("text"))


def with_clusters(docs: DataFrame) -> DataFrame:
    """`measured` rows of docs, whose cluster is the component of near copies, five words and a similarity of 0.8 or more.

    Texts are compared in lower case, so that exact copies regardless of case stay one cluster. It is
    null where a component has no doc_id. Words are counted and hashed in the read that finds near copies.
    """
    lower = docs.select("doc_id", F.lower(docs["text"].cast("string")).alias("text"), "source")
    found = minhash_dedup.decisions(lower, PERCENT, SHINGLE, measured=True)
    return found.select("doc_id", "source", "n", "exact", F.col("component_id").alias("cluster"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_measured(with_clusters(table(spark, sf_dir, "documents")))
