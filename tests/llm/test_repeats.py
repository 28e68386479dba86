import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from litro.llm import substring_dedup, suffix_dedup
from litro.llm.suffix_dedup import common_prefixes, suffix_array


def brute(rows, split, join):
    """Windows are looked up in a table of all windows and their least document."""
    units = [(i if i is not None else 1 << 62, split(t or "")) for i, t in rows]
    least = {}
    for i, u in units:
        for s in range(len(u) - 49):
            w = tuple(u[s : s + 50])
            least[w] = min(least.get(w, i), i)
    out = []
    for (i, _), (key, u) in zip(rows, units, strict=True):
        gone = [False] * len(u)
        for s in range(len(u) - 49):
            if least[tuple(u[s : s + 50])] < key:
                gone[s : s + 50] = [True] * 50
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = hashlib.sha256(join([x for x, g in zip(u, gone, strict=True) if not g])).hexdigest()
        out.append((i, len(u), sum(gone), runs, kept))
    return sorted(out, key=str)


def some_texts():
    r = random.Random(5)
    base = [" ".join(r.choice(["the", "of", "er", "on", "né"]) for _ in range(r.randrange(5, 400))) for _ in range(12)]
    rows = []
    for i in range(60):
        t = r.choice(base)
        if r.random() < 0.6:
            a = r.randrange(len(t))
            t = t[:a] + r.choice(["", "x", " zz ", r.choice(base)]) + t[a + r.randrange(9) :]
        rows.append((i * 3 % 61, t))
    rows += [(70, "a" * 333), (71, "b" + "a" * 200), (72, "y " * 130), (73, "z " + "y " * 80), (74, "y " * 70 + "\t\n q")]
    rows += [(80, None), (81, ""), (None, base[0]), (82, "é" * 60), (83, " " + "é" * 60), (5, base[3]), (5, base[3]), (84, "  ")]
    return rows


def test_suffix_array_orders_and_shares():
    r = np.random.default_rng(1)
    for n in (1, 2, 9, 300):
        text = r.integers(97, 99, n).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_array(text, n + 8)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        shared = common_prefixes(text, order)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            k = 0
            while max(a, b) + k < n and raw[a + k] == raw[b + k]:
                k += 1
            assert shared[b] == k


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, shard string, bucket int")


@pytest.mark.parametrize("shard_bytes", [1 << 24, 1500])
def test_bytes_against_brute_force(spark, shard_bytes):
    rows = some_texts()
    got = [
        (r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in suffix_dedup.suffix_dedup(frame(spark, rows), shard_bytes).collect()
    ]
    assert sorted(got, key=str) == brute(rows, lambda t: list(t.encode()), bytes)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("shard_bytes", [1 << 24, 1500])
def test_words_against_brute_force(spark, shard_bytes):
    rows = some_texts()
    got = [
        (r.doc_id, r.n_words, r.n_removed, len(r.removed), hashlib.sha256(r.kept.encode()).hexdigest())
        for r in substring_dedup.substring_dedup(frame(spark, rows), shard_bytes).collect()
    ]
    assert sorted(got, key=str) == brute(rows, lambda t: t.encode().split(), b" ".join)
    assert sum(r[2] for r in got) > 300


def test_empty_table(spark):
    none = frame(spark, [])
    assert suffix_dedup.suffix_dedup(none).collect() == []
    assert substring_dedup.substring_dedup(none).collect() == []


def test_long_text_crosses_chunks(spark, monkeypatch):
    from litro.llm import repeats

    monkeypatch.setattr(repeats, "CHUNK", 700)
    r = random.Random(2)
    long = " ".join(r.choice(["ab", "c", "def"]) for _ in range(3000))
    units = np.frombuffer(long.encode(), np.uint8)
    runs = repeats.Stretches(units, np.array([0, len(units)]), 50, 20)
    assert (runs.high - runs.low + 1).sum() == len(units) - 49


def shards_of(module, units, gram):
    """Two shards of the texts, and all stretches of each as they are sent."""
    from litro.llm import repeats

    rows = [(i, (t or "").encode()) for i, t in some_texts() if i is not None]
    shards, sent = [], []
    for part in (rows[::2], rows[1::2]):
        docs = pa.table({"doc_id": [i for i, _ in part], "text": pa.array([t for _, t in part], pa.binary())})
        shard = repeats.Shard(docs, units, 50, gram)
        one, least = shard.distinct(np.arange(len(shard.runs.low)))
        sizes = shard.runs.high[one] - shard.runs.low[one] + 1
        shards.append((shard, one, least))
        sent.append((module._payload(shard, one), sizes, least))
    return shards, sent


def least_by_table(shards):
    """The least id of each window by a plain table of windows."""
    least = {}
    windows = []
    for shard, one, ids in shards:
        mine = [
            (tuple(shard.units[s : s + 50].tolist()), int(i))
            for low, high, i in zip(shard.runs.low[one].tolist(), shard.runs.high[one].tolist(), ids.tolist(), strict=True)
            for s in range(low, high + 1)
        ]
        windows.append([w for w, _ in mine])
        for w, i in mine:
            least[w] = min(i, least.get(w, i))
    return [[least[w] for w in mine] for mine in windows]


BYTES = (suffix_dedup, lambda data, offsets: (data, offsets), suffix_dedup.GRAM)
WORDS = (substring_dedup, substring_dedup._units, substring_dedup.ANCHOR)


@pytest.mark.parametrize("kind", [BYTES, WORDS])
def test_shards_meet(kind):
    shards, sent = shards_of(*kind)
    assert [x.tolist() for x in kind[0].meet(sent)] == least_by_table(shards)


def test_ranges_of_strings_do_not_matter():
    shards, sent = shards_of(*BYTES)
    assert [x.tolist() for x in suffix_dedup.meet(sent, at_once=7)] == least_by_table(shards)


def test_equal_stretches_of_shards_are_sorted_once(monkeypatch):
    shards, sent = shards_of(*BYTES)
    sizes, sound = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, *a: (sizes.append(len(text)), sound(text, *a))[1])
    suffix_dedup.meet(sent[:1])
    once = sum(sizes)
    sizes.clear()
    many = [(payload, n, least + k) for k, (payload, n, least) in enumerate(sent[:1] * 5)]
    found = [x.tolist() for x in suffix_dedup.meet(many[::-1])]
    assert sum(sizes) == once
    assert found == least_by_table(shards[:1]) * 5


def test_result_hangs_on_the_suffix_order(monkeypatch):
    shards, sent = shards_of(*BYTES)
    sound = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda *a: sound(*a)[::-1].copy())
    with pytest.raises((IndexError, AssertionError)):
        assert [x.tolist() for x in suffix_dedup.meet(sent)] == least_by_table(shards)


def test_result_hangs_on_the_extension(monkeypatch):
    shards, sent = shards_of(*WORDS)
    monkeypatch.setattr(substring_dedup, "_classes", lambda *values: np.unique(values[0], return_inverse=True)[1])
    assert [x.tolist() for x in substring_dedup.meet(sent)] != least_by_table(shards)


@pytest.mark.parametrize("kind", [BYTES, WORDS])
def test_equal_fingerprints_of_different_stretches(kind):
    """With fingerprints of two bits only, stretches are told apart by their units."""
    (shard, _, _), _ = shards_of(*kind)[0]
    runs = shard.runs

    def content(k):
        return tuple(shard.units[runs.low[k] : runs.high[k] + 50].tolist()), int(runs.gram[k] - runs.low[k])

    runs.print &= np.uint64(3)
    one, least = shard.distinct(np.arange(len(runs.low)))
    want = {}
    for k in range(len(runs.low)):
        want[content(k)] = min(int(shard.owner[k]), want.get(content(k), 1 << 62))
    assert len(one) == len(want) and {content(k): i for k, i in zip(one.tolist(), least.tolist(), strict=True)} == want
    at = shard.answered(one[::-1])
    assert all(content(one[::-1][j]) == content(k) for k, j in enumerate(at.tolist()))
    assert (shard.answered(one[:1]) >= 0).sum() == sum(content(k) == content(one[0]) for k in range(len(runs.low)))
