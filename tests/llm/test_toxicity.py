import random
import zlib

import numpy as np

from litro.llm import toxicity


def corpus(n=900):
    r = random.Random(8)
    common = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = r.random() < 0.15
        text = [r.choice(common) for _ in range(r.randrange(20, 200))]
        if bad:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["nasty", "awful.", "VILE!", "lowsome", "lowsert"]))
        rows.append((i, " ".join(text), "x"))
        if r.random() < 0.6:
            labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_corner_cases(spark):
    rows, labels = corpus()
    extra = [(2000, None, "x"), (2001, "", "x"), (None, "nasty awful vile", "x"), (5, rows[5][1], "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (3, 7)], "doc_id long, toxic int")
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == len(rows) + 4
    truth = dict(labels)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert {r.predicted for r in got if r.doc_id in (2000, 2001)} == {0}
    assert {r.predicted for r in got if r.doc_id is None} == {1}
    assert toxicity.classify(docs.limit(0), marks).collect() == []
    assert {r.predicted for r in toxicity.classify(docs, marks.limit(0)).collect()} == {0}


def test_unlabelled_positives_are_not_learnt_as_negatives():
    r = np.random.default_rng(1)
    marked = r.random(4000) < 0.2  # toxic texts show feature 0
    x = np.stack([marked, r.random(4000) < 0.5], 1).astype(np.float32)
    positive = marked & (r.random(4000) < 0.3)
    w, bias = toxicity.non_negative_pu(x, positive, 0.2)
    assert w[0] + bias > 0.5 and bias + max(0, w[1]) < 0


def test_sums_in_tasks_are_those_of_the_driver(spark, monkeypatch):
    """The same weights whether patterns are added up on the driver or in tasks; every text counts once."""
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "ROUNDS", 5)
    monkeypatch.setattr(toxicity.minimise, "__defaults__", (5,))
    here = toxicity.fit(docs, marks)
    monkeypatch.setattr(toxicity, "MOST_PATTERNS", 0)
    there = toxicity.fit(docs, marks)
    assert len(here.weights) and np.allclose(here.weights, there.weights, atol=1e-12) and abs(here.bias - there.bias) < 1e-12


def test_sums_of_patterns_are_those_of_rows():
    r = np.random.default_rng(3)
    x = (r.random((200, 4)) < 0.3).astype(np.float64)
    positive = r.random(200) < 0.2
    w, bias = r.standard_normal(4), -0.3
    each = toxicity.Patterns.of([np.flatnonzero(v).tolist() for v in x], positive.tolist(), [1] * 200).sums(w, bias)
    counts = {}
    for v, p in zip(x, positive):
        key = bool(p), tuple(np.flatnonzero(v).tolist())
        counts[key] = counts.get(key, 0) + 1
    grouped = toxicity.Patterns.of([list(k[1]) for k in counts], [k[0] for k in counts], list(counts.values())).sums(w, bias)
    z = x @ w + bias
    down = 1 / (1 + np.exp(-z))
    assert np.allclose(each, grouped)
    assert np.isclose(each[0], np.logaddexp(0, z)[~positive].sum())
    assert np.allclose(each[2 + 10 :], [*(x[~positive].T @ down[~positive]), down[~positive].sum()])


def test_words_of_few_texts_among_many_are_learnt(spark):
    """More unlabelled texts than any sample would hold; toxic words in a few of them."""
    clean = [(i, f"plain text number{i % 50} here", "") for i in range(12_000)]
    bad = [(100_000 + i, f"plain vileword text{i % 7}", "") for i in range(60)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string, score string").repartition(6)
    marks = spark.createDataFrame([(i, int(i >= 100_000)) for i, _, _ in clean[:300] + bad[:30]], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.classify(docs, marks).collect()}
    assert all(got[i] == 1 for i, _, _ in bad) and not any(got[i] for i, _, _ in clean)
