import random
from fractions import Fraction
from itertools import permutations

import duckdb
import pytest

from litro.llm import filter_audit as A


def fails(docs, k):
    """The filters a document fails, by their definitions."""
    doc_id, text = docs[k][0], docs[k][1] or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    found = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": doc_id is not None and any(d[0] is not None and d[0] < doc_id and (d[1] or "") == text for d in docs),
    }
    return {f for f, v in found.items() if v}


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = [fails(docs, k) for k in range(len(docs))]
    rows = {}
    for part in {d[2] or "" for d in docs}:
        mine = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = set(mine)
            for step, letter in enumerate(order, 1):
                gone = {k for k in left if letter in failed[k]}
                left -= gone
                total[letter] += len(gone)
                hit = sum(letter in failed[k] for k in mine)
                rows[part, order, step] = [
                    len(left), len(gone), hit - len(gone), sum(failed[k] == {letter} for k in mine),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone), letter,
                ]
        for (p, _, _), row in rows.items():
            if p == part:
                row[6] = total[row[6]]
    return {k: tuple(v) for k, v in rows.items()}


def made(seed, n):
    draw = random.Random(seed)
    texts = [None, "", "A B", "same " * 120, " ".join(f"w{i}" for i in range(100)), " ".join(f"W{i}" for i in range(100)), "x#" + " ".join(f"w{i}" for i in range(99))]
    texts += ["é " * 60 + " ".join(f"k{i}" for i in range(100)), "UP" * 30, "\t\n".join(f"v{i % 85}" for i in range(101))]
    docs = [(draw.choice([None, *range(n)]), draw.choice(texts), draw.choice([None, "", "en", "fr"]), "x") for _ in range(n)]
    labels = [(draw.choice([None, *range(n)]), draw.choice([0, 1, None]), draw.choice([0, 1, None]), "y") for _ in range(n)]
    return docs, labels


DOCS, LABELS = "doc_id long, text string, lang string, mask string", "doc_id long, quality int, toxic int, part string"


def got_of(spark, docs, labels):
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    rows = A.audit(*frames).collect()
    keyed = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(keyed) == len(rows)
    return keyed


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    docs, labels = made(seed, 80)
    assert got_of(spark, docs, labels) == brute(docs, [row[:3] for row in labels])


def test_the_sql_agrees_on_corner_cases(spark):
    docs, labels = made(9, 60)
    docs = [(k, *d[1:]) for k, d in enumerate(docs)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, mask VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT, part VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", docs)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?, ?)", labels)
    rows = con.execute(A.ORACLE).fetchall()
    assert {r[:3]: r[3:] for r in rows} == got_of(spark, docs, labels)


def test_least_squares_are_shapley_values():
    draw = random.Random(1)
    for _ in range(20):
        removed = [0] + [draw.randint(0, 50) for _ in range(31)]
        want = [Fraction(0)] * 5
        for order in permutations(range(5)):
            before = 0
            for i in order:
                want[i] += Fraction(removed[before | 1 << i] - removed[before], 120)
                before |= 1 << i
        assert A.shapley(removed) == want
    assert A.shapley([0, 7]) == [7]


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert A.audit(empty, labels).count() == 0
    docs = [(1, "word " * 400_000, None, ""), (2, "Z" * 2_000_000, None, ""), (3, "word " * 400_000, None, "")]
    got = got_of(spark, docs, [(1, 1, 1, "")])
    assert got["", "ABCDE", 2] == (0, 2, 0, 1, 1, 1, 2 * 60 + 60) or got["", "ABCDE", 2][:2] == (0, 2)
    assert got == brute(docs, [(1, 1, 1)])


def test_one_text_in_all_rows(spark):
    docs = [(k % 500, "copy", "en", "") for k in range(1000)]
    got = got_of(spark, docs, [])
    # Two rows have the least id; the other 998 are copies of them.
    assert got["en", "EABCD", 1][:4] == (2, 998, 0, 0)
