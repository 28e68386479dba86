"""Removal of byte strings that an earlier document already has, by suffix arrays.

Stretches of text that may repeat get a suffix array (Larsson-Sadakane refinement) and common prefixes
(Kasai's rule), equal stretches of several shards once; suffixes with 50 bytes in common are one string.
Where the stretches around a gram fill several arrays, their sorted strings are merged by binary search,
which compares the strings themselves. See `repeats` for how stretches are found and dealt.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm import repeats
from litro.llm.common import LAST_ID, table

LENGTH = 50
#: Bytes of the gram that a window is found by.
GRAM = 20
#: Windows that are sorted at once; sorted strings of a part that are merged with those of others at once.
STRINGS = 1 << 16


def _eight(text: np.ndarray) -> np.ndarray:
    """The next eight bytes at each place as one number, zeros after the end."""
    n = len(text)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = text
    for d in (1, 2, 4):
        wide[: n + 8 - d] = (wide[: n + 8 - d] << np.uint64(8 * d)) | wide[d:]
        if d < 4:  # the places after the end stay zero
            wide[n:] = 0
    return wide[:n]


def suffix_array(text: np.ndarray, depth: int, room: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes at least.

    Suffixes are ordered by eight bytes first. Each round then orders the groups that are still
    equal by the rank of the suffix h bytes on, which doubles the bytes compared; groups of one
    suffix are left alone. room: bytes that count of each suffix; one that has fewer than a round
    compares takes no part in it, and its order beyond them is open.
    """
    n = len(text)
    head = _eight(text)
    order = np.argsort(head)
    ordered = head[order]
    new = np.r_[n > 0, ordered[1:] != ordered[:-1]][:n]
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = np.flatnonzero(~(new & np.r_[new[1:], True]))
    h = 8
    while h < depth and len(open_):
        if room is not None:
            # What a later round looks up, or in the last round the suffixes in full.
            least = depth if 2 * h >= depth else min(2 * h, max(depth - 2 * h, h + 1))
            open_ = open_[room[order[open_]] >= least]
        suffix = order[open_]
        value = rank[suffix] * (n + 2) + rank[np.minimum(suffix + h, n)] + 1
        by = np.argsort(value)
        suffix, value = suffix[by], value[by]
        order[open_] = suffix
        new = np.r_[len(by) > 0, value[1:] != value[:-1]][: len(by)]
        rank[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~(new & np.r_[new[1:], True])]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix in `order`, by its place in the text, how many bytes it shares with the one before it.

    Kasai's rule: if the suffix before is preceded by the neighbour of the previous suffix, and the
    two preceding bytes are equal, the value is the previous suffix's less one. Only the others are
    compared, eight bytes a step.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (before[1:] == before[:-1] + 1)
    place = np.flatnonzero(follows)
    follows[place] = text[place - 1] == text[before[place - 1]]
    head = np.r_[_eight(text), np.zeros(8, np.uint64)]
    shared = np.zeros(n, np.int64)
    at = np.flatnonzero(~follows & (before >= 0))
    other, d = before[at], 0
    while len(at):
        differ = head[np.minimum(at + d, n)] ^ head[np.minimum(other + d, n)]
        same = (differ == 0).astype(np.int64)
        for k in range(1, 8):
            same += differ < np.uint64(1 << 8 * k)
        room = np.maximum(n - np.maximum(at, other) - d, 0)
        shared[at] += np.minimum(same, room)
        go = (same == 8) & (room > 8)
        at, other, d = at[go], other[go], d + 8
    source = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return np.where(follows, shared[source] - (np.arange(n) - source), shared)


def _payload(shard: repeats.Shard, stretches: np.ndarray) -> bytes:
    """The bytes of the stretches, and eight bits of each one's gram."""
    low, high = shard.runs.low[stretches], shard.runs.high[stretches]
    place, _ = repeats.spread(low, high - low + LENGTH)
    return zstandard.compress(shard.runs.key[stretches].astype(np.uint8).tobytes() + shard.units[place].tobytes(), 1)


class Strings:
    """The distinct strings of some stretches in sorted order, each with its least document id, and the string of each window."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray, least: np.ndarray):
        self.text = text
        n = sizes + LENGTH - 1
        start, _ = repeats.spread(np.cumsum(n) - n, sizes)
        room = np.repeat(np.cumsum(n), n) - np.arange(len(text))
        order = suffix_array(text, LENGTH, room)
        wanted, owner = np.zeros(len(text), bool), np.zeros(len(text), np.int64)
        wanted[start], owner[start] = True, np.repeat(least, sizes)
        kept = order[wanted[order]]
        new = common_prefixes(text, kept)[kept] < LENGTH
        new[:1] = True
        self.first = kept[new]
        ahead = self.text[self.first[:, None] + np.arange(8)].view(">u8").ravel()
        if (ahead[1:] < ahead[:-1]).any():  # strings are merged by binary search
            raise AssertionError("strings do not ascend")
        self.least = np.minimum.reduceat(owner[kept], np.flatnonzero(new))
        number = np.zeros(len(text), np.int64)
        number[kept] = np.cumsum(new) - 1
        self.of_window = number[start]

    def cut(self, string: bytes) -> int:
        """How many strings are smaller."""
        return bisect_left(range(len(self.first)), string, key=lambda k: self.text[self.first[k] : self.first[k] + LENGTH].tobytes())

    def between(self, low: int, high: int) -> np.ndarray:
        bytes_ = self.text[self.first[low:high, None] + np.arange(LENGTH)]
        return bytes_.view(f"S{LENGTH}").ravel()


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The distinct strings of sorted lists, sorted: of two lists, the strings of one are looked up in the other by binary search."""
    while len(lists) > 1:
        pairs = [sorted(lists[k : k + 2], key=len) for k in range(0, len(lists), 2)]
        lists = []
        for few, *many in pairs:
            if many:
                at = np.searchsorted(many[0], few)
                new = np.ones(len(few), bool)
                inside = at < len(many[0])
                new[inside] = many[0][at[inside]] != few[inside]
                few = np.insert(many[0], at[new], few[new])
            lists.append(few)
    return lists[0]


class Pool:
    """The different stretches that shards sent, each once: bytes, number of windows, least document id, and bits of the gram."""

    def __init__(self, sent: list[tuple[bytes, np.ndarray, np.ndarray]]):
        sizes = np.concatenate([n for _, n, _ in sent])
        raw = [repeats.expand(payload, np.uint8) for payload, _, _ in sent]
        grams = np.concatenate([x[: len(n)] for x, (_, n, _) in zip(raw, sent, strict=True)])
        data = np.concatenate([x[len(n) :] for x, (_, n, _) in zip(raw, sent, strict=True)])
        bounds = np.r_[0, np.cumsum(sizes + LENGTH - 1)]
        every = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        self.of_sent = every.indices.to_numpy().astype(np.int64)
        self.text, self.bounds = repeats.flat_bytes(pa.chunked_array([every.dictionary]))
        self.sizes = np.diff(self.bounds) - LENGTH + 1
        self.least = np.full(len(self.sizes), LAST_ID, np.int64)
        np.minimum.at(self.least, self.of_sent, np.concatenate([x for _, _, x in sent]))
        self.gram = np.zeros(len(self.sizes), np.int64)
        self.gram[self.of_sent] = grams

    def strings(self, some: np.ndarray) -> Strings:
        place, _ = repeats.spread(self.bounds[some], self.sizes[some] + LENGTH - 1)
        return Strings(self.text[place], self.sizes[some], self.least[some])


def _joined(parts: list[Strings], at_once: int) -> list[np.ndarray]:
    """The least document id of each string over all parts. Strings are merged range by range, about `at_once` of a part in each."""
    if len(parts) == 1:
        return [parts[0].least]
    longest = max(parts, key=lambda s: len(s.first))
    pivots = [longest.text[p : p + LENGTH].tobytes() for p in longest.first[at_once::at_once].tolist()]
    cuts = [[0, *(s.cut(p) for p in pivots), len(s.first)] for s in parts]
    least = [np.zeros(len(s.first), np.int64) for s in parts]
    for r in range(len(pivots) + 1):
        lists = [s.between(c[r], c[r + 1]) for s, c in zip(parts, cuts, strict=True)]
        every = merged(lists)
        best = np.full(len(every), LAST_ID, np.int64)
        places = [np.searchsorted(every, strings) for strings in lists]
        for s, c, at in zip(parts, cuts, places, strict=True):
            best[at] = np.minimum(best[at], s.least[c[r] : c[r + 1]])
        for mine, c, at in zip(least, cuts, places, strict=True):
            mine[c[r] : c[r + 1]] = best[at]
    return least


def meet(sent: list[tuple[bytes, np.ndarray, np.ndarray]], at_once: int = STRINGS) -> list[np.ndarray]:
    """The least document id of each window over all shards.

    Equal stretches of several shards are sorted once. Equal windows have equal grams, so that stretches
    are sorted gram by gram, those of about `at_once` windows together; where more have the same bits of a
    gram, the parts of them are merged.
    """
    pool = Pool(sent)
    first = np.cumsum(pool.sizes) - pool.sizes
    least = np.zeros(int(pool.sizes.sum()), np.int64)
    groups = min(256, -(-2 * len(least) // at_once))
    group = pool.gram * groups >> 8
    order = np.argsort(group, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        part = (np.cumsum(pool.sizes[some]) - 1) // at_once
        parts = np.split(some, np.flatnonzero(np.diff(part)) + 1)
        strings = [pool.strings(x) for x in parts]
        for x, s, best in zip(parts, strings, _joined(strings, at_once), strict=True):
            place, _ = repeats.spread(first[x], pool.sizes[x])
            least[place] = best[s.of_window]
    found = []
    for k in np.split(pool.of_sent, np.cumsum([len(n) for _, n, _ in sent])[:-1]):
        place, _ = repeats.spread(first[k], pool.sizes[k])
        found.append(least[place])
    return found


def _finish(shard: repeats.Shard, cover: np.ndarray) -> pa.Table:
    step = np.diff(np.r_[0, cover.astype(np.int8), 0])
    spans, kept = [], []
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    bounds = shard.bounds.tolist()
    # A run that crosses from one document into the next is cut there.
    inner = shard.bounds[1:-1]
    touch = inner[(inner > 0) & (inner < len(cover))]
    touch = np.unique(touch[cover[touch - 1] & cover[touch]]) if len(touch) else touch
    begin, end = np.sort(np.r_[begin, touch]), np.sort(np.r_[end, touch])
    left, right = np.searchsorted(begin, shard.bounds[:-1]), np.searchsorted(begin, shard.bounds[1:])
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        i, j = left[k], right[k]
        spans.append([{"start": int(x) - a, "end": int(y) - a} for x, y in zip(begin[i:j], end[i:j], strict=True)])
        kept.append((shard.data[a:b][~cover[a:b]] if i < j else shard.data[a:b]).tobytes())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            "doc_id": shard.docs["doc_id"],
            "n_bytes": pa.array(np.diff(shard.bounds)),
            "removed": pa.array(spans, kind),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def suffix_dedup(docs: DataFrame, shard_bytes: int = repeats.SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed array of [start, end), kept binary), a row for each row of docs.

    Removed is each byte covered by a 50-byte string that also starts in a document with a smaller
    doc_id. Nulls: a missing text is empty; a missing doc_id counts as larger than all others.
    Texts of fewer than 50 bytes lose nothing. Rows with equal doc_id are not earlier than each
    other; repeated rows each get the same result. An empty table gives no rows. Other columns are
    ignored.
    """
    return repeats.repeated(
        docs,
        LENGTH,
        GRAM,
        lambda data, offsets: (data, offsets),
        _payload,
        meet,
        _finish,
        "doc_id long, n_bytes long, removed array<struct<start: bigint, end: bigint>>, kept binary",
        shard_bytes,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = suffix_dedup(table(spark, sf_dir, "documents"))
    return result.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
