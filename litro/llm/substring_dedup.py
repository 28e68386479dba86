"""Removal of word sequences that an earlier document already has, by seed and extend.

Seeds are winnowed anchors: of every 50 words the 12-word gram with the least hash. Documents meet
where they share an anchor. There each match is extended word by word to the left and to the right:
stretches with the same words up to a distance stay in one class, of which the least document id
counts, so that no pair of stretches is formed. A match that reaches 50 words with those of an
earlier document is kept; neighbouring ones join to maximal repeats.
See `repeats` for how anchors and extensions are dealt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litro.llm import repeats
from litro.llm.common import LAST_ID, table

LENGTH = 50
#: Words of an anchor.
ANCHOR = 12


class _Hashes(dict):
    """64-bit hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, bounds = [], [0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        words = data[a:b].tobytes().split()
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
        bounds.append(bounds[-1] + len(words))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(bounds)


def _payload(shard: repeats.Shard, stretches: np.ndarray) -> bytes:
    """The distinct words of the stretches; which of them stand in each, and where its anchor is."""
    if not hasattr(shard, "words"):
        shard.words = [w for a, b in zip(shard.offsets[:-1].tolist(), shard.offsets[1:].tolist(), strict=True) for w in shard.data[a:b].tobytes().split()]
    runs = shard.runs
    place, _ = repeats.spread(runs.low[stretches], runs.high[stretches] - runs.low[stretches] + LENGTH)
    numbers: dict[bytes, int] = {}
    used = [numbers.setdefault(shard.words[i], len(numbers)) for i in place.tolist()]
    vocabulary = b" ".join(numbers)
    head = np.array([len(vocabulary), len(stretches)], np.int64).tobytes()
    anchors = (runs.gram[stretches] - runs.low[stretches]).astype(np.uint8).tobytes()
    return zstandard.compress(head + vocabulary + anchors + np.array(used, np.uint32).tobytes(), 1)


def _classes(*values: np.ndarray) -> np.ndarray:
    """A number for each distinct row of values below 2**31."""
    both = values[0]
    for v in values[1:]:
        both = (both << 32) | v
    return np.unique(both, return_inverse=True)[1]


def meet(sent: list[tuple[bytes, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The least document id of each window over all shards.

    A stretch offers `left` words before its anchor and `right` words after it. Step d to one side
    parts each class by the word at that distance. What agrees in l words to the left and in
    50 - 12 - l to the right is one repeat of 50 words.
    """
    numbers: dict[bytes, int] = {}
    texts, anchors = [], []
    for payload, sizes, _ in sent:
        raw = zstandard.decompress(payload)
        n, stretches = np.frombuffer(raw, np.int64, 2).tolist()
        known = np.array([numbers.setdefault(w, len(numbers)) for w in raw[16 : 16 + n].split()], np.int64)
        anchors.append(np.frombuffer(raw, np.uint8, stretches, 16 + n).astype(np.int64))
        texts.append(known[np.frombuffer(raw[16 + n + stretches :], np.uint32)])
    text, left = np.concatenate(texts), np.concatenate(anchors)
    sizes, owner = (np.concatenate([x[k] for x in sent]) for k in (1, 2))
    begin = np.cumsum(sizes + LENGTH - 1) - (sizes + LENGTH - 1)
    anchor, rest = begin + left, LENGTH - ANCHOR
    right = sizes + LENGTH - 1 - left - ANCHOR
    seed = np.zeros(len(sizes), np.int64)
    for k in range(ANCHOR):
        seed = _classes(seed, text[anchor + k])

    def extended(offered: np.ndarray, place) -> list[np.ndarray]:
        """Classes after 0, 1, … words to one side; what offers fewer words keeps its last class, which nobody asks for."""
        steps = [seed]
        for d in range(1, rest + 1):
            here = np.flatnonzero(offered >= d)
            now = steps[-1].copy()
            now[here] = _classes(now[here], text[place(here, d)])
            steps.append(now)
        return steps

    lefts = extended(left, lambda here, d: anchor[here] - d)
    rights = extended(right, lambda here, d: anchor[here] + ANCHOR + d - 1)
    first = np.cumsum(sizes) - sizes
    least = np.zeros(sizes.sum(), np.int64)
    for l in range(rest + 1):  # noqa: E741
        here = np.flatnonzero((left >= l) & (right >= rest - l))
        if not len(here):
            continue
        repeat = _classes(lefts[l][here], rights[rest - l][here])
        best = np.full(int(repeat.max()) + 1, LAST_ID, np.int64)
        np.minimum.at(best, repeat, owner[here])
        least[first[here] + left[here] - l] = best[repeat]
    return np.split(least, np.cumsum([x[1].sum() for x in sent])[:-1])


def _finish(shard: repeats.Shard, cover: np.ndarray) -> pa.Table:
    removed, kept = [], []
    bounds = shard.bounds.tolist()
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        words = shard.data[shard.offsets[k] : shard.offsets[k + 1]].tobytes().split()
        hide = cover[a:b]
        step = np.diff(np.r_[0, hide.astype(np.int8), 0])
        begin, end = np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()
        removed.append([{"start": x, "end": y} for x, y in zip(begin, end, strict=True)])
        if begin:
            words = [w for w, h in zip(words, hide.tolist(), strict=True) if not h]
        kept.append(b" ".join(words))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            "doc_id": shard.docs["doc_id"],
            "n_words": pa.array(np.diff(shard.bounds)),
            "n_removed": pa.array(np.diff(np.r_[0, np.cumsum(cover)][shard.bounds])),
            "removed": pa.array(removed, kind),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
        }
    )


def substring_dedup(docs: DataFrame, shard_bytes: int = repeats.SHARD_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, removed array of word places [start, end), kept text).

    Removed is each word covered by 50 consecutive words that also start in a document with a
    smaller doc_id; what is kept is joined by single spaces. Nulls: a missing text has no words; a
    missing doc_id counts as larger than all others. Texts of fewer than 50 words lose nothing. Rows
    with equal doc_id are not earlier than each other; repeated rows each get the same result. An
    empty table gives no rows. Other columns are ignored.
    """
    return repeats.repeated(
        docs,
        LENGTH,
        ANCHOR,
        _units,
        _payload,
        meet,
        _finish,
        "doc_id long, n_words long, n_removed long, removed array<struct<start: bigint, end: bigint>>, kept string",
        shard_bytes,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = substring_dedup(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
