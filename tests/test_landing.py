import zipfile

import pytest

from litro.sources import archives
from litro.sources.archives import committed, land_archives


def make(root, name, members, ano=2024, half=1):
    folder = root / f"ano={ano}" / f"semestre={half}"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, text in members.items():
            archive.writestr(member, text)


def csvs(bronze):
    return {p.name: p.read_text() for p in bronze.rglob("*.csv")}


@pytest.fixture
def places(tmp_path):
    return tmp_path / "zip", tmp_path / "bronze"


def land(spark, places):
    return land_archives(spark, *map(str, places)).collect()


def test_a_late_archive_lands_beside_the_first(spark, places):
    source, bronze = places
    make(source, "um.zip", {"p.csv": "A\n1\n"})
    assert [r.erro for r in land(spark, places)] == [None]
    assert csvs(bronze) == {"p.csv": "A\n1\n"}
    make(source, "dois.zip", {"p.csv": "A\n2\n"})
    late = land(spark, places)
    assert [(r.path.rsplit("/", 1)[-1], r.bytes) for r in late] == [("dois.zip", 4)]
    assert csvs(bronze) == {"p.csv": "A\n1\n", "dois__p.csv": "A\n2\n"}
    assert land(spark, places) == []
    states = committed(spark, str(bronze)).groupBy("estado").count().collect()
    assert {r.estado: r["count"] for r in states} == {archives.PLANNED: 2, archives.LANDED: 2}


def test_a_changed_archive_replaces_what_it_landed(spark, places):
    source, bronze = places
    make(source, "um.zip", {"old.csv": "A\n1\n"})
    land(spark, places)
    make(source, "um.zip", {"new.csv": "A\n22\n", "leia.txt": "?"})
    assert [(r.bytes, r.erro) for r in land(spark, places)] == [(5, None)]
    assert csvs(bronze) == {"new.csv": "A\n22\n"}
    make(source, "um.zip", {"new.csv": "A\n33\n"})
    land(spark, places)
    assert csvs(bronze) == {"new.csv": "A\n33\n"} and land(spark, places) == []


def test_a_run_that_died_is_taken_up_again(spark, places, monkeypatch):
    """Files landed, their commit did not."""
    source, bronze = places
    make(source, "um.zip", {"p.csv": "A\n1\n"})
    commit = archives._commit

    def dying(rows, root, state):
        if state == archives.LANDED:
            raise OSError("driver lost")
        commit(rows, root, state)

    monkeypatch.setattr(archives, "_commit", dying)
    with pytest.raises(OSError, match="driver lost"):
        land(spark, places)
    assert csvs(bronze) == {"p.csv": "A\n1\n"}
    monkeypatch.undo()
    assert [r.erro for r in land(spark, places)] == [None]
    assert csvs(bronze) == {"p.csv": "A\n1\n"} and land(spark, places) == []


def test_partitions_of_another_origin_are_skipped(spark, places):
    source, bronze = places
    for half in (1, 2):
        make(source, "um.zip", {"p.csv": "A\n1\n"}, half=half)
    folder = bronze / "ano=2024" / "semestre=1"
    folder.mkdir(parents=True)
    (folder / "dados.csv").write_text("A\n9\n")
    assert [r.semestre for r in land(spark, places)] == [2]
    assert csvs(bronze) == {"dados.csv": "A\n9\n", "p.csv": "A\n1\n"}


def test_a_repaired_archive_lands(spark, places):
    source, bronze = places
    folder = source / "ano=2024" / "semestre=1"
    folder.mkdir(parents=True)
    (folder / "um.zip").write_bytes(b"PK" * 50)
    broken = land(spark, places)
    assert [(r.crc, r.membros_csv, r.destino) for r in broken] == [(None, 0, None)] and broken[0].erro
    make(source, "um.zip", {"p.csv": "A\n1\n", "q.csv": "B\n"})
    assert [r.membros_csv for r in land(spark, places)] == [2] and csvs(bronze) == {}
    make(source, "um.zip", {"p.csv": "A\n1\n"})
    assert [r.erro for r in land(spark, places)] == [None] and csvs(bronze) == {"p.csv": "A\n1\n"}


def test_a_damaged_member_is_its_archives_error(spark, places):
    source, bronze = places
    make(source, "mau.zip", {"p.csv": "A\n" + "12345\n" * 2000})
    make(source, "bom.zip", {"p.csv": "A\n1\n"}, half=2)
    path = source / "ano=2024" / "semestre=1" / "mau.zip"
    data = bytearray(path.read_bytes())
    data[40:50] = b"\xff" * 10
    path.write_bytes(bytes(data))
    rows = {r.semestre: r for r in land(spark, places)}
    assert rows[1].erro and rows[1].destino is None and rows[2].erro is None
    assert csvs(bronze) == {"p.csv": "A\n1\n"}
    assert not [p for p in bronze.rglob(".*.csv.*") if not p.name.endswith(".crc")]


def test_no_archives(spark, places):
    source, bronze = places
    make(source, "um.zip", {"p.csv": "A\n1\n"})
    land(spark, places)
    (source / "ano=2024" / "semestre=1" / "um.zip").unlink()
    (source / "ano=2024" / "semestre=1" / "leia.txt").write_text("x")
    make(source, "tres.zip", {"p.csv": "A\n3\n"})
    land(spark, places)
    # The first archive is gone, but what it landed is known: names stay apart.
    assert csvs(bronze) == {"p.csv": "A\n1\n", "tres__p.csv": "A\n3\n"}
