import hashlib
import random
import re
import time

import pytest

from litro.llm import credentials as C

SCHEMA = "doc_id long, text string, kind string, spans int"


def spans_of(spark, texts, **given):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: [tuple(s) for s in r.spans] for r in C.find(docs, **given).collect()}


def by_patterns(text):
    """The contract's patterns as they are written."""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(C.KINDS[k], a, b) for a, k, b in sorted(out)]


HEX40 = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
TEXTS = [
    None,
    "",
    f'a Token = "{HEX40}" b',
    "password: hunter2 passwd=hunter22",
    'token="token:abcdefghij"',
    "AKIA1234567890AB and AKIAAKIA1234 AKIA" + "Z" * 40,
    "API_KEY='abc.def/ghi' apikey:x secret=.......",
    "ſecret=abcdefghij toKen=abcdefghij",
    "é" * 5 + "f" * 31 + " " + "f" * 32 + "F",
    "\U0001f600 secret = " + HEX40 + " " + HEX40,
    "token" * 50,
    "token" + " " * 3000 + "x",
]


def test_base_spans_are_the_patterns(spark):
    got = spans_of(spark, TEXTS)
    for k, text in enumerate(TEXTS):
        assert [s for s in got[k] if s[0] != C.LEARNT] == by_patterns(text or ""), text


def test_base_spans_of_random_texts():
    draw = random.Random(4)
    parts = ["password", "TOKEN", "api_key", "secret", "=", ":", " ", '"', "'", "AKIA", "abcdef0123", "ABC123", "x", "é", "\n", ".", "f" * 33]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))
        found = [(kind, a, b) for a, b, kind, _ in C.base_spans(text)]
        assert found == by_patterns(text)
        # Words judged one by one hold the candidates that the whole text holds.
        if not found:
            plain, others, _ = C.spread(text)
            formats = [s * n for (s, n), times in plain.items() for _ in range(times)]
            formats += [C.format_of(m[0]) for w in others for m in C.CANDIDATE.finditer(w)]
            assert sorted(formats) == sorted(C.format_of(v) for _, _, v in C.candidates(text, []))


@pytest.mark.parametrize(
    ("value", "shape"),
    [("1234", "0000"), ("12af", "xxxx"), ("12AF", "XXXX"), ("abc", "aaa"), ("ABC", "AAA"), ("aBc", "mmm"), ("1xy", "yyy"), ("1XY", "YYY"), ("a1B", "zzz"), ("a-1/B=", "a-0/A=")],
)
def test_formats(value, shape):
    assert C.format_of(value) == shape and set(shape) <= set(C.SYMBOLS)


def test_compatible_states_are_merged():
    """Words of any length, geometrically distributed, make one state with a loop; words of one length make a chain."""
    loop = C.infer({"a" * n: 2 ** (14 - n) for n in range(1, 14)})
    assert len(loop) <= 2 and any(i in s.next.values() for i, s in enumerate(loop))
    chain = C.infer({"x" * 12: 500})
    assert len(chain) == 13 and [s.ends for s in chain] == [0] * 12 + [500]
    either = C.infer({"a" * 6: 300, "0" * 6: 300})
    # What follows the first symbol differs, so it is kept apart.
    assert C.likelihood(either, "aaaaaa") > C.likelihood(either, "aaa000") + 3


def test_merging_keeps_counts():
    formats = {"ab" * k + "0" * j: k + j for k in range(4) for j in range(1, 5)}
    tree = C.prefix_tree(formats)
    merged = C.infer(formats)
    assert sum(s.ends for s in merged) == sum(s.ends for s in tree) == sum(formats.values())
    assert all(0 <= t < len(merged) for s in merged for t in s.next.values())
    assert all(s.count == s.ends + sum(s.seen.values()) for s in merged)


def test_likelihoods_are_a_distribution():
    automaton = C.infer({"x" * 3: 50, "x" * 4: 30, "a-a": 20})
    import itertools
    import math

    short = sum(math.exp(C.likelihood(automaton, "".join(w))) for n in range(5) for w in itertools.product(C.SYMBOLS, repeat=n))
    assert 0.9 < short <= 1 + 1e-9


def prose(draw, n):
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(3, 13))) for _ in range(n))


def test_learnt_formats_are_found_where_no_pattern_looks(spark):
    """Keys in the format of labelled ones, without a name before them; clean texts stay clean."""
    draw = random.Random(6)

    def key():
        return "sk-" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdefghijklmnopqrstuvwxyz") for _ in range(24)) + "aB3"

    texts = [f'{prose(draw, 20)} secret = "{key()}" {prose(draw, 20)}' for _ in range(300)]
    bare = [f"{prose(draw, 20)} ({key()}), {prose(draw, 5)}" for _ in range(100)]
    clean = [prose(draw, 60) + " internationalization state-of-the-art 2024-05-06 12345678 Wiederherstellung" for _ in range(300)]
    got = spans_of(spark, texts + bare + clean)
    for k, text in enumerate(texts + bare + clean):
        learnt = [text[a:b] for kind, a, b in got[k] if kind == C.LEARNT]
        if 300 <= k < 400:
            assert len(learnt) == 1 and learnt[0].startswith("sk-") and len(learnt[0]) == 30
        else:
            assert learnt == []


def test_without_the_merging_no_new_length_is_found(spark):
    """The automaton generalises over lengths its prefix tree has not seen."""
    draw = random.Random(7)
    lengths = [draw.randint(16, 40) for _ in range(400)]
    formats = {}
    for n in lengths:
        if n != 30:
            formats["z" * n] = formats.get("z" * n, 0) + 1
    merged = C.infer(formats)
    tree = C.prefix_tree(formats)
    assert len(merged) < len(tree)
    assert C.likelihood(merged, "z" * 30) > C.likelihood(tree, "z" * 30) + 1


def test_learnt_spans_touch_no_base_span():
    base = C.base_spans(f"token={HEX40} x")
    assert list(C.candidates(f"token={HEX40} x", base)) == []
    text = f"token='{HEX40}'-abcdefgh1 zzzzzzzz"
    assert [v for _, _, v in C.candidates(text, C.base_spans(text))] == ["-abcdefgh1", "zzzzzzzz"]


def test_empty_table_repeats_and_missing_ids(spark):
    assert C.find(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, f"token={HEX40}", "", 0), (1, f"token={HEX40}", "", 0), (1, f"token={HEX40}", "", 0)], SCHEMA)
    rows = C.find(docs).collect()
    assert len(rows) == 3 and {str(r.spans) for r in rows} == {str(rows[0].spans)}


def test_very_long_texts(spark):
    long = ["a1" * 500_000, "secret=" + "Q" * 1_000_000, f"token={HEX40} " * 20_000, "f" * 1_000_000, "token " * 100_000]
    start = time.time()
    got = spans_of(spark, long)
    assert time.time() - start < 60
    assert got[1] == [("assign", 0, 1_000_007)] and len(got[2]) == 40_000 and ("hex", 0, 1_000_000) in got[3]


def test_query_columns(spark):
    rows = C.query(spark, "/root/testdata/sf0.001").collect()
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(documents)
    for r in rows:
        base = by_patterns(documents[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in C.KINDS]
        assert [s for s in r.spans.split(",") if s and not s.startswith(C.LEARNT)] == [s for s in line.split(",") if s]
