import random

import pyarrow as pa

from litro.llm import graph, minhash_dedup


def brute(rows, percent=85, size=3):
    def shingle(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = t.encode().split()
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [shingle(t) for _, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in zip(rows, sets, strict=True):
        for b, y in zip(rows, sets, strict=True):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a[0]), find(b[0])))
                root[q] = p
    return sorted((i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets, strict=True))


def rows_with_copies():
    r = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(40):
        base = [r.choice(words) for _ in range(r.randrange(1, 120))]
        for _ in range(r.randrange(1, 6)):
            copy = list(base)
            for _ in range(r.randrange(4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            if r.random() < 0.3:
                copy = copy + [r.choice(words)]
            rows.append(" ".join(copy).title() if r.random() < 0.2 else "\t".join(copy))
    r.shuffle(rows)
    return [(i * 7 + 1, t) for i, t in enumerate(rows)] + [(5000, None), (5001, ""), (5002, " "), (5003, "É x"), (5004, "é x"), (5005, "É X")]


def test_against_brute_force(spark):
    rows = rows_with_copies()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, a int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect())
    assert got == brute(rows)
    assert sum(not r[3] for r in got) > 20


def test_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCS", 2)
    rows = rows_with_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect())
    assert got == brute(rows)


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "z")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert (3, 2, 3, True) in got and (None, 2, 3, False) in got and len(got) == 3
    assert minhash_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_rows_of_one_id_do_not_link_others(spark):
    """Unrelated documents stay apart when rows without doc_id, or of one doc_id, are near copies of each."""
    x, y, z = (" ".join(f"{c}{k}" for k in range(40)) for c in "xyz")
    rows = [(5, x), (7, y), (None, x + " more"), (None, y + " more"), (9, x + " else"), (9, y + " else"), (None, z), (None, z + " more"), (None, z)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()))
    assert got == [
        (0, 38, 0, True), (0, 38, 0, True), (0, 39, 0, True), (0, 39, 5, False), (0, 39, 7, False),
        (5, 38, 5, True), (7, 38, 7, True), (9, 39, 5, False), (9, 39, 7, False),
    ]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 200), (7, 7)], "a long, b long")
    got = {(r.a, r.b) for r in graph.components(links).collect()}
    assert got == {(k, 0) for k in range(1, 61)} | {(200, 100)}


def test_sets_of_many_texts_are_those_of_each(monkeypatch):
    texts = [t or "" for _, t in rows_with_copies()] + ["", " ", "a", "A b", "a b C d", " \x0b\u00c9  \u00e9\n", "\x1c x \u3000 y \x85z"]
    for size in (1, 3, 5):
        sets, n = minhash_dedup.shingle_sets(minhash_dedup.word_lists(pa.array(texts)), size)
        assert [x.tolist() for x in sets] == [minhash_dedup.shingles(t, size).tolist() for t in texts]
        assert n.tolist() == [len(t.encode().split()) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(["k"] * len(texts)), pa.array(texts)], ["doc_id", "text_key", "text"])
    whole = pa.Table.from_batches(minhash_dedup._signatures(3)([batch])).to_pylist()
    monkeypatch.setattr(minhash_dedup, "BATCH_BYTES", 300)
    assert pa.Table.from_batches(minhash_dedup._signatures(3)([batch, batch.slice(0, 0)])).to_pylist() == whole
