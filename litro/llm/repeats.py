"""Windows of consecutive units (bytes or words) that also start in a document with a smaller id.

Two shuffles of small rows find them without moving every window:

1. Each shard of documents picks, for each window, the gram with the least hash (winnowing): equal
   windows pick equal grams. Shards send their distinct grams to buckets; a bucket tells which grams
   occur in two documents.
2. Shards send only the stretches of windows around such grams to the buckets, equal stretches of a
   shard once, with the least document id. A bucket finds the least id of every window and answers.

Hashes only propose: which stretches of a shard are equal is decided by their units, and which
windows of two shards are, by what the caller's `meet` compares.

A gram in a third of all documents reaches its bucket once from each shard, so no bucket holds a
group that grows with the number of its copies. Texts are shuffled once; both later passes of a
shard read the same exchange again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litro.llm.common import LAST_ID, id_and_text, total_bytes

#: Text bytes of a shard.
SHARD_BYTES = 8 << 20
#: Units hashed at once; a text of any length is read in such pieces.
CHUNK = 1 << 20
#: Pairs of stretches compared at once.
PAIRS = 1 << 15
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_STEP, _BACK))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def prefix_sums(units: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _powers(CHUNK + 4096)[0][: len(units)], out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of units[start:stop] within one chunk."""
    return mix((sums[stop] - sums[start]) * _powers(CHUNK + 4096)[1][start])


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values, where its least value is, by all bits but the last 21 (the leftmost of equal ones).

    Place and value are one number, so that a step is one minimum. Up to 2**21 values.
    """
    places = np.uint64((1 << 21) - 1)
    least, span = (values & ~places) | np.arange(len(values), dtype=np.uint64), 1
    while span < width:
        d = min(span, width - span)
        least = np.minimum(least[d:], least[:-d])
        span += d
    return (least & places).astype(np.int64)


class Stretches:
    """Runs of windows that pick the same gram: first and last window start, gram start, gram hash, fingerprint of all units."""

    def __init__(self, units: np.ndarray, bounds: np.ndarray, length: int, gram: int):
        valid = np.ones(len(units), bool)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            valid[max(a, b - length + 1) : b] = False
        found = []
        for c in range(0, len(units), CHUNK):
            part = units[c : c + CHUNK + length - 1]
            s = np.flatnonzero(valid[c : c + max(0, len(part) - length + 1)])
            if not len(s):
                continue
            sums = prefix_sums(part)
            i = np.arange(len(part) - gram + 1)
            grams = fingerprints(sums, i, i + gram)
            p = leftmost_least(grams, length - gram + 1)[s]
            first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)])
            low, high = s[first], s[np.r_[first[1:] - 1, len(s) - 1]]
            # Least hashes are small numbers: mixed again, they spread evenly over the buckets.
            key = mix(grams[p[first]] + np.uint64(1))
            found.append((low + c, high + c, p[first] + c, key, fingerprints(sums, low, high + length)))
        none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
        self.low, self.high, self.gram, self.key, self.print = (np.concatenate(x) for x in zip(*(found or [none]), strict=True))


def spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start, start + 1, … of each run of `size` places, and where each run begins in it."""
    first = np.cumsum(size) - size
    return np.arange(size.sum()) - np.repeat(first, size) + np.repeat(start, size), first


def by_value(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order, and where each distinct value begins in it."""
    order = np.argsort(values)
    v = values[order]
    return order, np.flatnonzero(np.r_[len(v) > 0, v[1:] != v[:-1]][: len(v)])


def pack(values: np.ndarray) -> bytes:
    """Differences of neighbours, byte by byte, compressed."""
    v = np.ascontiguousarray(values).view(np.uint64)
    planes = np.diff(v, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def squeeze(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 3)


def expand(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grows with the key, so that sorted keys of a bucket lie together. Up to 2**32 buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _cuts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if not len(bucket):
        return
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
        yield int(bucket[a]), a, b


def flat_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and where each begins and the last ends."""
    array = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks] or [pa.array([], pa.large_binary())])
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Shard:
    """The documents of one shard, by id and text, and their stretches."""

    def __init__(self, docs: pa.Table, to_units: Callable, length: int, gram: int):
        self.docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.data, self.offsets = flat_bytes(self.docs["text"])
        self.ids = self.docs["doc_id"].fill_null(LAST_ID).to_numpy()
        self.units, self.bounds = to_units(self.data, self.offsets)
        self.length, self.runs = length, Stretches(self.units, self.bounds, length, gram)
        self.owner = self.ids[np.searchsorted(self.bounds, self.runs.low, "right") - 1]

    def same(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether stretches `one` and `other`, pair by pair, have the same units and their gram in the same place."""
        runs = self.runs
        same = (runs.high[one] - runs.low[one] == runs.high[other] - runs.low[other]) & (runs.gram[one] - runs.low[one] == runs.gram[other] - runs.low[other])
        for a in range(0, len(one), PAIRS):
            part = slice(a, a + PAIRS)
            here = np.flatnonzero(same[part] & (one[part] != other[part])) + a
            if not len(here):
                continue
            places, first = spread(runs.low[one[here]], runs.high[one[here]] - runs.low[one[here]] + self.length)
            shift = np.repeat(runs.low[other[here]] - runs.low[one[here]], np.diff(np.r_[first, len(places)]))
            same[here] = np.logical_and.reduceat(self.units[places] == self.units[places + shift], first)
        return same

    def answered(self, known: np.ndarray) -> np.ndarray:
        """For each stretch its place in `known`, a list of stretches that differ from each other; -1 if it is not there.

        Those of equal fingerprint are compared unit by unit, with one after another where several share it.
        """
        runs = self.runs
        by = np.argsort(runs.print[known], kind="stable")
        prints = runs.print[known][by]
        found = np.full(len(runs.low), -1, np.int64)
        open_, at = np.arange(len(found)), np.searchsorted(prints, runs.print)
        while len(open_):
            here = at < len(prints)
            here[here] = prints[at[here]] == runs.print[open_[here]]
            open_, at = open_[here], at[here]
            same = self.same(open_, known[by[at]])
            found[open_[same]] = by[at[same]]
            open_, at = open_[~same], at[~same] + 1
        return found

    def distinct(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One of each sort of equal stretches among the chosen, and the least document id of the sort."""
        picked, least = [], []
        while len(chosen):
            order, first = by_value(self.runs.print[chosen])
            ordered = chosen[order]
            one = np.repeat(ordered[first], np.diff(np.r_[first, len(ordered)]))
            same = self.same(ordered, one)
            picked.append(ordered[first])
            least.append(np.minimum.reduceat(np.where(same, self.owner[ordered], LAST_ID), first))
            chosen = ordered[~same]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *picked]), np.concatenate([none, *least])


def repeated(
    docs: DataFrame,
    length: int,
    gram: int,
    to_units: Callable,
    to_payload: Callable,
    meet: Callable,
    finish: Callable,
    schema: str,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """finish(shard, cover) for each shard, cover telling the units to remove.

    to_units(data, offsets): units and bounds. to_payload(shard, stretches): what describes them.
    meet([(payload, windows of each stretch, least id of each stretch) of each shard]): the least id
    that any shard has for each window, in order, for each shard.
    """
    docs = id_and_text(docs)
    shards = max(1, -(-total_bytes(docs) // shard_bytes))
    buckets = shards
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard"), "doc_id", "text")
    dealt = dealt.repartition(shards, "shard")

    def grams(key, group):
        runs = (shard := Shard(group, to_units, length, gram)).runs
        order, first = by_value(runs.key)
        if len(first):
            owner = shard.owner[order]
            several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        distinct = runs.key[order][first]
        rows = [
            (b, key[0].as_py(), pack(distinct[i:j]), np.packbits(several[i:j]).tobytes())
            for b, i, j in _cuts(bucket_of(distinct, buckets))
        ]
        return _table(rows, GRAMS)

    def shared(key, group):
        sent = [unpack(x) for x in group["grams"].to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(s)) for x, s in zip(group["several"].to_pylist(), sent, strict=True)]
        every, counts = np.unique(np.concatenate(sent), return_counts=True)
        hit = counts > 1
        for s, t in zip(sent, twice, strict=True):
            hit[np.searchsorted(every, s[t > 0])] = True
        rows = [
            (shard, key[0].as_py(), len(s), np.packbits(hit[np.searchsorted(every, s)]).tobytes())
            for shard, s in zip(group["shard"].to_pylist(), sent, strict=True)
        ]
        return _table(rows, HITS)

    def stretches(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _table([], SENT)
        runs = (shard := Shard(left, to_units, length, gram)).runs
        hits = sorted(zip(right["bucket"].to_pylist(), right["n"].to_pylist(), right["hit"].to_pylist(), strict=True))
        hit = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for _, n, x in hits]) > 0
        chosen = np.flatnonzero(hit[np.searchsorted(np.unique(runs.key), runs.key)])
        one, least = shard.distinct(chosen)
        if not len(one):
            return _table([], SENT)
        bucket = bucket_of(runs.key[one], buckets)
        by = np.lexsort((runs.key[one].astype(np.uint8), bucket))
        one, least, bucket = one[by], least[by], bucket[by]
        rows = []
        for b, i, j in _cuts(bucket):
            low, high = runs.low[one[i:j]], runs.high[one[i:j]]
            sizes = (high - low + 1).astype(np.uint8)
            rows.append((b, key[0].as_py(), pack(low), squeeze(sizes), squeeze(least[i:j]), to_payload(shard, one[i:j])))
        return _table(rows, SENT)

    def answer(key, group):
        got = group.to_pylist()
        sizes = [expand(r["sizes"], np.uint8).astype(np.int64) for r in got]
        found = meet([(r["payload"], n, expand(r["least"], np.int64)) for r, n in zip(got, sizes, strict=True)])
        rows = [(r["shard"], r["lows"], r["sizes"], pack(least)) for r, least in zip(got, found, strict=True)]
        return _table(rows, ANSWERS)

    def remove(key, left, right):
        shard = Shard(left, to_units, length, gram)
        starts = np.zeros(len(shard.units) + 1, np.int32)
        if right.num_rows:
            lows = np.concatenate([unpack(x) for x in right["lows"].to_pylist()]).view(np.int64)
            sizes = np.concatenate([expand(x, np.uint8) for x in right["sizes"].to_pylist()]).astype(np.int64)
            least = np.concatenate([unpack(x) for x in right["least"].to_pylist()]).view(np.int64)
            begin = np.cumsum(sizes) - sizes
            at = shard.answered(np.searchsorted(shard.runs.low, lows))
            run = np.flatnonzero(at >= 0)
            which, n = at[run], (shard.runs.high - shard.runs.low + 1)[run]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            smaller = least[np.repeat(begin[which], n) + step] < np.repeat(shard.owner[run], n)
            starts[(np.repeat(shard.runs.low[run], n) + step)[smaller]] = 1
        seen = np.cumsum(starts[:-1], dtype=np.int32)
        cover = seen > 0
        cover[length:] = seen[length:] > seen[:-length]
        return finish(shard, cover)

    hits = (
        dealt.groupBy("shard").applyInArrow(grams, GRAMS_DDL).repartition(buckets, "bucket")
        .groupBy("bucket").applyInArrow(shared, HITS_DDL).repartition(shards, "shard")
    )
    answers = (
        dealt.groupBy("shard").cogroup(hits.groupBy("shard")).applyInArrow(stretches, SENT_DDL)
        .repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, ANSWERS_DDL).repartition(shards, "shard")
    )
    return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(remove, schema)


GRAMS_DDL = "bucket long, shard long, grams binary, several binary"
HITS_DDL = "shard long, bucket long, n long, hit binary"
SENT_DDL = "bucket long, shard long, lows binary, sizes binary, least binary, payload binary"
ANSWERS_DDL = "shard long, lows binary, sizes binary, least binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


GRAMS, HITS, SENT, ANSWERS = map(_schema, (GRAMS_DDL, HITS_DDL, SENT_DDL, ANSWERS_DDL))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
