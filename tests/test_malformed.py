"""Lines with too many fields or bytes that are not UTF-8, judged as the CSV reader reads them."""

import random

from pyspark.sql import functions as F

from litro.sources import delimited


def fields(line):
    """A state machine over one line: a quote opens a field only at its start, a doubled one stays inside,
    what follows the closing one belongs to the field, and without one the field is the rest."""
    state, count, i = "start", 1, 0
    while i < len(line):
        c, following = line[i], line[i + 1 : i + 2]
        if state == "start" and c == '"':
            state = "quoted"
        elif state == "quoted" and c == '"' and following == '"':
            i += 1
        elif state == "quoted" and c == '"':
            state = "after"
        elif state != "quoted" and c == ";":
            state, count = "start", count + 1
        elif state == "start":
            state = "plain"
        i += 1
    return count


CASES = {
    "": 1,
    ";": 2,
    ";;": 3,
    "a;b": 2,
    '"a;b";c': 2,
    '"a;b"c;d': 2,
    'a"b;c"d': 2,
    '"a""b;c"': 1,
    '"a;b': 1,
    ';"a;b";': 3,
    '"";""': 2,
    ' "a;b"': 2,
    '"a"";b;c': 1,
}


def drawn(n, seed=1):
    draw = random.Random(seed)
    lines = ("".join(draw.choice('";;"ax é') for _ in range(draw.randint(1, 14))) for _ in range(n))
    return [x for x in lines if x.strip()]


def test_the_state_machine_knows_the_cases():
    assert {k: fields(k) for k in CASES} == CASES


def test_field_count_is_the_state_machine(spark):
    lines = [*CASES, *drawn(5000)]
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    got = frame.select("line", delimited.field_count(F.col("line")).alias("n")).collect()
    assert [(r.line, r.n) for r in got if r.n != fields(r.line)] == []


def test_field_count_is_what_the_reader_reads(spark, tmp_path):
    """A mark is appended as a last field; where the reader finds it tells how many came before."""
    lines = sorted({*drawn(2000, 3), *(c for c in CASES if c.strip())})
    folder = tmp_path / "ano=2024" / "semestre=1"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("h\n" + "".join(f"{x};#\n" for x in lines))
    rows = delimited.read_fields(spark, str(tmp_path), 20).select("*").collect()
    assert len(rows) == len(lines)
    for row in rows:
        line, got = row._line.removesuffix(";#"), list(row)[:20]
        if "#" in got:
            assert got.index("#") == fields(line), line
        else:  # a quote that is never closed takes the mark along
            assert fields(line + ";#") == fields(line), line


def test_state_of_lines(spark, tmp_path):
    folder = tmp_path / "ano=2024" / "semestre=1"
    folder.mkdir(parents=True)
    text = [b"A;B", b"1;2", b"1;2;3", b"1;2;", b'"1;2";3', b'1;"2;3', b"1", b";;", b"\xc3x;1", b"\xc3x;1;2", b'x"y;"z"', b'a;b"c;d"', b"1;2;3;4;5;6"]
    (folder / "a.csv").write_bytes(b"\n".join(text) + b"\n")
    (folder / "b.csv").write_bytes(b"A;B;C\n1;2;3\n1;2;3;4\n1;2;3;\n")
    scanned = delimited.scan_bronze(spark, str(tmp_path), with_state=True)
    states = sorted((r._estado or "", r.A or "", r.B or "", r.C or "") for r in scanned.collect())
    assert [s for s in states if not s[0]] == sorted(
        [("", "1", "2", ""), ("", "1;2", "3", ""), ("", "1", "2;3", ""), ("", "1", "", ""), ("", 'x"y', "z", ""), ("", "1", "2", "3")]
    )
    assert [s[0] for s in states if s[0]] == sorted(["bytes inválidos", "campos excedentes e bytes inválidos", *["campos excedentes"] * 7])
    assert [tuple(r) for r in delimited.malformed_rows(scanned).collect()] == [(2024, 1, 8, 2)]
    numbers = [r._linha for r in scanned.where("_estado IS NOT NULL").collect()]
    assert len(set(numbers)) == len(numbers) == 9
