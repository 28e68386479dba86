import pytest

from litro.sources import commit


def put(root, partition, text):
    folder = root / partition
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.parquet").write_text(text)


def held(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*.parquet")}


A, B, C = ("ano=2024/semestre=1", "ano=2024/semestre=2", "ano=2025/semestre=1")


@pytest.fixture
def folders(tmp_path):
    staged, root = tmp_path / "staged", tmp_path / "root"
    for partition in (A, B, C):
        put(staged, partition, f"new {partition}")
    put(root, A, "old")
    (root / A / "left.parquet").write_text("old too")
    return staged, root


def test_named_partitions_replace_whole_folders(spark, folders):
    staged, root = folders
    commit.publish_folders(spark, str(staged), str(root), [A, C])
    assert held(root) == {f"{p}/part-0.parquet": f"new {p}" for p in (A, C)}
    # Moved, not copied; the other stays staged; nothing hidden is left.
    assert set(held(staged)) == {f"{B}/part-0.parquet"}
    assert {p.name for p in root.iterdir()} == {"ano=2024", "ano=2025"}


def test_a_failed_rename_leaves_the_old_partition_whole(spark, folders, monkeypatch):
    staged, root = folders
    rename = commit.Store.rename

    def failing(self, source, target):
        if target.toString().endswith(A) and commit.NEW in source.toString():
            raise OSError("lost")
        rename(self, source, target)

    monkeypatch.setattr(commit.Store, "rename", failing)
    with pytest.raises(OSError, match="lost"):
        commit.publish_folders(spark, str(staged), str(root), [C, A, B])
    assert held(root) == {f"{A}/part-0.parquet": "old", f"{A}/left.parquet": "old too", f"{C}/part-0.parquet": f"new {C}"}
    assert {p.name for p in root.iterdir()} == {"ano=2024", "ano=2025"}


def test_a_failure_while_bringing_publishes_nothing(spark, folders):
    staged, root = folders
    before = held(root)
    with pytest.raises(Exception, match="absent"):
        commit.publish_folders(spark, str(staged), str(root), [A, "ano=2030/semestre=absent"])
    assert held(root) == before


def test_a_run_that_died_is_recovered(spark, folders):
    """The old folder was moved away, the new one had not come."""
    staged, root = folders
    hidden = root / f"{commit.OLD}dead" / "ano=2024"
    hidden.mkdir(parents=True)
    (root / A).rename(hidden / "semestre=1")
    put(root, f"{commit.NEW}dead/{A}", "half")
    commit.publish_folders(spark, str(staged), str(root), [C])
    assert held(root) == {f"{A}/part-0.parquet": "old", f"{A}/left.parquet": "old too", f"{C}/part-0.parquet": f"new {C}"}
    assert {p.name for p in root.iterdir()} == {"ano=2024", "ano=2025"}


def test_copies_where_the_store_cannot_rename(spark, folders, monkeypatch):
    """Another scheme's store over the same disk."""
    staged, root = folders
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.other.link./s", f"file://{staged}")
    commit.publish_folders(spark, "viewfs://other/s", str(root), [A, B])
    assert held(root) == {f"{p}/part-0.parquet": f"new {p}" for p in (A, B)}
    assert set(held(staged)) == {f"{p}/part-0.parquet" for p in (A, B, C)}
    assert not list(root.rglob("_*"))


def test_readers_do_not_see_hidden_folders(spark, tmp_path):
    root = tmp_path / "layer"
    spark.range(3).selectExpr("id", "2024 AS ano", "1 AS semestre").write.partitionBy("ano", "semestre").parquet(str(root))
    spark.range(5).write.parquet(str(root / f"{commit.NEW}x" / A))
    spark.range(5).write.parquet(str(root / f"{commit.OLD}x" / A))
    assert spark.read.parquet(str(root)).count() == 3
