"""Near-duplicate documents by MinHash with tensored banding; links are confirmed on full sets.

A document gets two small collections of band values, 8 of 2 minhashes each. Its 64 table keys are
all pairs of a value of the first collection with one of the second: 32 minhashes do the work of 64
independent keys of 4. Two sets of similarity s miss each other with a probability below
2 * (1 - s**2) ** 8, which is 0.00007 at s = 0.85.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm.common import LAST_ID, cut, id_and_text, sized, table
from litro.llm.graph import components

SHINGLE = 3
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Band values of a collection, and minhashes of a band value.
VALUES, ROWS = 8, 2
#: A group of candidates is confirmed in blocks of so many shingles and documents at most.
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 20, 4096
#: Texts whose words are hashed together, and their bytes; a longer text is hashed alone.
BATCH, BATCH_BYTES = 1024, 8 << 20
#: Members of candidate groups that may be sent to every executor: 50 MB or less.
MOST_SENT = 400_000

_RANDOM = np.random.default_rng(20240501).integers(0, 1 << 63, (2, 2 * VALUES * ROWS), dtype=np.int64).view(np.uint64)
_TIMES, _PLUS = _RANDOM[0] | np.uint64(1), _RANDOM[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n neighbours."""
    value = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        value = _mix(value + h[k : len(h) - n + 1 + k])
    return value


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; all words as one where there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return _distinct(_rolled(h, min(size, len(h))))


def word_lists(texts: pa.Array) -> pa.Array:
    """The words of each text, lower-cased in A-Z; one empty word where there are none."""
    return pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))


def shingle_sets(lists: pa.Array, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """`shingles` of each list of `word_lists`, and its number of words. Each different word is hashed once."""
    flat = lists.flatten()
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h = known[coded.indices.to_numpy()]
    n = pc.list_value_length(lists).to_numpy().astype(np.int64)
    begin = np.cumsum(n) - n
    empty = n == 1
    empty[empty] = pc.binary_length(flat).to_numpy()[begin[empty]] == 0
    rolled = _rolled(h, size) if len(h) >= size else None
    sets = []
    for a, k, none in zip(begin.tolist(), n.tolist(), empty.tolist(), strict=True):
        if none:
            sets.append(np.zeros(0, np.uint64))
        else:
            sets.append(_distinct(rolled[a : a + k - size + 1] if k >= size else _rolled(h[a : a + k], k)))
    return sets, np.where(empty, 0, n)


def minhashes(values: np.ndarray) -> np.ndarray:
    least = np.full(len(_TIMES), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), 1 << 12):
        np.minimum(least, (_TIMES[:, None] * values[i : i + (1 << 12)] + _PLUS[:, None]).min(1), out=least)
    return least


def _bands(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band values of both collections for each row of minhashes."""
    rows = least.reshape(-1, 2, VALUES, ROWS)
    value = rows[..., 0]
    for k in range(1, ROWS):
        value = _mix(value) + rows[..., k]
    value = _mix(value).view(np.int64)
    return value[:, 0].ravel(), value[:, 1].ravel()


SIGNED = "doc_id long, text_key string, n_shingles long, set_a long, set_b long, left array<long>, right array<long>"
#: What `measured` adds to it.
MEASURED = "source string, n long, exact long"


def _signatures(size: int, measured: bool = False):
    """Columns of SIGNED; measured: those of MEASURED too, exact being Spark's xxhash64 of the words joined by one space."""

    def signed(batch):
        lists = word_lists(batch["text"])
        sets, n = shingle_sets(lists, size)
        left, right = _bands(np.stack([minhashes(values) for values in sets]))
        sizes, once = np.array([len(values) for values in sets]), _mix(np.concatenate(sets))
        places = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * VALUES)
        columns = {
            "doc_id": batch["doc_id"],
            "text_key": batch["text_key"],
            "n_shingles": pa.array(sizes),
            "set_a": pa.array(_sums(once, sizes)),
            "set_b": pa.array(_sums(_mix(once), sizes)),
            "left": pa.ListArray.from_arrays(places, pa.array(left)),
            "right": pa.ListArray.from_arrays(places, pa.array(right)),
        }
        if measured:
            joined = pc.binary_join(lists, " ").cast(pa.large_binary()).to_numpy(zero_copy_only=False)
            exact = np.array([xxhash.xxh64_intdigest(x, seed=42) for x in joined], np.uint64)
            columns |= {"source": batch["source"], "n": pa.array(n), "exact": pa.array(exact.view(np.int64))}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches):
        for batch in batches:
            size_of = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64))
            k = 0
            while k < batch.num_rows:
                full = int(np.searchsorted(size_of, (size_of[k - 1] if k else 0) + BATCH_BYTES, "right"))
                stop = max(k + 1, min(k + BATCH, full))
                yield signed(batch.slice(k, stop - k))
                k = stop

    return run


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of values, modulo 2**64."""
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)]
    end = np.cumsum(sizes)
    return (sums[end] - sums[end - sizes]).view(np.int64)


def _sets(size: int):
    def run(batches):
        for batch in batches:
            sets = [shingles(t.as_py(), size).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["vertex"], batch["group"], batch["low"], batch["high"], batch["block"], pa.array(sets, pa.binary())],
                ["vertex", "group", "low", "high", "block", "shingles"],
            )

    return run


def _confirm(percent: int):
    """Links within a group: enough to connect all that are linked, each confirmed on full sets."""

    def run(key, group):
        docs = group["vertex"].to_numpy()
        block = group["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets])
        cross = key[1].as_py() != key[2].as_py()
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        begin = np.cumsum(size) - size
        held = np.zeros(token.max() + 1, np.int32)
        root = np.arange(len(docs))
        links = []
        for i in range(len(docs)):
            if (root == root[0]).all():
                break
            mine = token[begin[i] : begin[i] + size[i]]
            held[mine] = 1
            common = np.add.reduceat(held[token], begin)
            held[mine] = 0
            linked = (100 * common >= percent * (size + size[i] - common)) & (root != root[i])
            if cross:
                linked &= block != block[i]
            for j in np.flatnonzero(linked).tolist():
                if root[j] != root[i]:
                    links.append((max(docs[i], docs[j]), min(docs[i], docs[j])))
                    root[root == root[j]] = root[i]
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def with_text_key(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with text_key, which tells texts apart where doc_id does not; a missing text is empty."""
    return docs.withColumn("text_key", F.md5(F.coalesce(docs[text].cast("string"), F.lit(""))))


def decisions(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, measured: bool = False) -> DataFrame:
    """near_duplicates with text_key: rows of one doc_id and text_key have one decision.

    measured: also the row's source, the number n of its words, and a hash of these, lower-cased in A-Z, as `exact`.
    """
    rows = id_and_text(docs)
    if measured:
        rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), docs["source"].cast("string").alias("source"))
    rows = with_text_key(rows)
    signed = cut(rows.mapInArrow(_signatures(shingle, measured), f"{SIGNED}, {MEASURED}" if measured else SIGNED))
    docs = rows.select("doc_id", "text", "text_key")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text_key")).alias("first")
    sets = signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("least_id"), first, F.any_value("left").alias("left"), F.any_value("right").alias("right")
    )
    # A vertex is a distinct set; its number is fixed as the rows are written.
    sets = cut(sets.withColumn("vertex", F.monotonically_increasing_id()))
    keys = sets.select("vertex", "right", F.posexplode("left").alias("i", "x"))
    keys = keys.select("vertex", "i", "x", F.posexplode("right").alias("j", "y"))
    keys = keys.select("vertex", F.xxhash64("i", "j", "x", "y").alias("key"))
    # The least and greatest vertex of a key: where they differ, the key is a candidate.
    tables = keys.groupBy("key").agg(F.min("vertex").alias("b"), F.max("vertex").alias("top")).where("b < top")
    candidates = keys.join(tables.select("key", "b"), "key").where("vertex > b").select(F.col("vertex").alias("a"), "b")
    grouped = components(candidates.distinct())
    members = grouped.select(F.col("a").alias("vertex"), F.col("b").alias("group"))
    members = members.union(grouped.select("b", "b").distinct())
    members = members.join(sets.select("vertex", "n_shingles", "first.doc_id", "first.text_key"), "vertex")
    shares = members.groupBy("group").agg(
        F.ceil(F.greatest(F.sum("n_shingles") / BLOCK_SHINGLES, F.count("*") / BLOCK_DOCS)).cast("long").alias("blocks")
    )
    members = cut(members.join(shares, "group").select("vertex", "doc_id", "text_key", "group", "blocks"))
    texts = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text_key", "text")
    # Few members are sent to the texts; texts are shuffled where there are many.
    # One text of each set: repeated rows, and equal texts without doc_id, count once.
    full = texts.join(sized(members, MOST_SENT), ["doc_id", "text_key"]).groupBy("vertex", "group", "blocks").agg(F.any_value("text").alias("text"))
    full = full.withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks")))
    full = full.select("vertex", "group", "block", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    full = full.select("vertex", "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "text")
    full = full.mapInArrow(_sets(shingle), "vertex long, group long, low long, high long, block long, shingles binary")
    links = full.groupBy("group", "low", "high").applyInArrow(_confirm(percent), "a long, b long")
    found = components(links)
    found = found.union(found.select("b", "b").distinct())
    linked = found.join(sets.select(F.col("vertex").alias("a"), "least_id"), "a")
    least = linked.groupBy("b").agg(F.min("least_id").alias("component"))
    found = found.join(least, "b").select(F.col("a").alias("vertex"), "component")
    sets = sets.select("vertex", "set_a", "set_b", "n_shingles", "least_id").join(found, "vertex", "left")
    sets = sets.select("set_a", "set_b", "n_shingles", F.coalesce("component", "least_id").alias("component"))
    more = [c.split()[0] for c in MEASURED.split(", ")] if measured else []
    result = signed.select("doc_id", "text_key", "n_shingles", "set_a", "set_b", *more).join(sets, ["set_a", "set_b", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return result.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
        *more,
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of docs.

    Words are lower-cased in A-Z. Documents whose shingle sets have 100 * intersection >= percent *
    union are linked; component_id is the least doc_id that links lead to. Nulls: a missing text is
    empty, linked with nothing and kept; rows without doc_id are linked by their text like all others,
    and their component_id is null, and they are kept, unless links lead to a row with one. Repeated
    rows share a component and are kept or not together; rows that share a doc_id but not a text are
    each linked by their own text. An empty table gives no rows. Other columns are ignored. Documents
    with equal sets are one candidate; a candidate group too large for a task is confirmed block
    against block.
    """
    return decisions(docs, percent, shingle).drop("text_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
