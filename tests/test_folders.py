"""Layers cut from the tables: which rows they hold, and that writing them moves no rows."""

import zipfile
from collections import Counter
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from litro.session import stage
from litro.sources.archives import land_archives
from litro.sources.delimited import scan_bronze
from litro.workload import folders, views


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def lineitems(spark, folder):
    """Tables of a few rows, with null keys, keys that repeat and a part of an unknown type."""
    tables = {
        "region": ([(1, "AFRICA"), (2, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(3, "NATION_3", 1), (15, "NATION_15", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S1", 3), (2, "S2", 15), (2, "S2b", 3), (None, "S", 3), (4, "S4", None)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "part": ([(1, "B1", "SMALL"), (2, None, "LARGE"), (3, "B3", "ODD"), (None, "B", "LARGE")], "p_partkey bigint, p_brand string, p_type string"),
    }
    lines = [
        (part, supplier, number, quantity, 10.5 * number, discount, 0.0, f"1996-0{number}-01")
        for number, (part, supplier, quantity, discount) in enumerate(
            [(1, 1, 50.0, 0.0), (2, 2, 50.0, 0.1), (3, 1, 1.0, 0.0), (None, 1, 1.0, 0.0), (1, None, 2.0, None), (1, 4, 3.0, 0.0), (2, 1, None, None)], 1
        )
    ]
    tables["lineitem"] = (
        lines,
        "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, day string",
    )
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df = df.withColumn("l_shipdate", F.to_timestamp("day")).drop("day") if name == "lineitem" else df
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_observations_and_raw_text(spark, tmp_path):
    obs = views.observations(spark, lineitems(spark, str(tmp_path)))
    found = sorted((r.l_linenumber, r.revenda, r.produto or "", r.unidade_medida, r.uf, r.regiao_oficial) for r in obs.collect())
    assert found == [
        (1, "S1", "GNV", "R$ / m³", "AM", "Norte"),
        (2, "S2", "DIESEL", "R$ / litro", "MT", "Centro-Oeste"),
        (2, "S2b", "DIESEL", "R$ / litro", "AM", "Norte"),
        (3, "S1", "", "R$ / litro", "AM", "Norte"),
        (7, "S1", "DIESEL", "R$ / litro", "AM", "Norte"),
    ]
    raw = Counter((r["Numero Rua"], r["Revenda"]) for r in views.raw(obs).collect())
    assert raw == {("1", "S1"): 2, ("2", "S2"): 2, ("2", "S2b"): 2, ("3", "S1"): 1, (None, "S1"): 1, (None, None): 2}


def test_layers_are_written_without_a_shuffle_for_folders(spark, tmp_path, monkeypatch):
    """Each task writes the rows it has: no rebalance, and no sort by folder."""
    text = plan_of(views.raw(views.observations(spark, lineitems(spark, str(tmp_path / "in")))))
    assert text.count("Relation [l_partkey") + text.count("lineitem") <= 1 and "Union" not in text
    seen = []
    monkeypatch.setattr(folders, "stage", lambda df, target, *by: seen.append((plan_of(df), by)) or stage(df, target, *by))
    folders.observations(spark, str(tmp_path / "in"))
    assert seen and all("RebalancePartitions" not in plan for plan, _ in seen) and seen[0][1] == ("ano", "semestre")


def test_semester_sizes_need_no_window(spark, tmp_path):
    lines = views.observed_lines(views.observations(spark, lineitems(spark, str(tmp_path))))
    assert "Window" not in plan_of(lines) and lines.count() == 5


def text_of_three_headers(spark, folder):
    """Observations of years with each of the headers, a name that needs quotes, copies, blank rows and nulls."""
    obs = views.observations(spark, lineitems(spark, folder))
    years = spark.createDataFrame([(1996,), (1998,), (2001,)], "y int")
    name = F.when(F.col("l_linenumber") == 1, 'POSTO; "A"\\').when(F.col("l_linenumber") == 3, "").otherwise(F.col("revenda"))
    day = F.make_date("y", F.month("data_coleta"), F.dayofmonth("data_coleta"))
    return obs.crossJoin(years).withColumns({"ano": F.col("y"), "data_coleta": day, "revenda": name}).drop("y").repartition(3)


def test_archives_hold_the_raw_text_without_a_copy_of_it_on_disk(spark, tmp_path, monkeypatch):
    obs = stage(text_of_three_headers(spark, str(tmp_path / "in")), str(tmp_path / "obs"))
    monkeypatch.setattr(folders, "observed", lambda *_: obs)
    with monkeypatch.context() as patch:
        patch.setattr(folders, "bronze", None)
        archives = folders.archives(spark, str(tmp_path / "in"))
    manifest = land_archives(spark, archives, str(tmp_path / "landed"))
    assert manifest.where("erro IS NOT NULL").isEmpty() and manifest.select("ano").distinct().count() == 3
    landed, written = (
        Counter(tuple(r.asDict().items()) for r in scan_bronze(spark, root).collect())
        for root in (str(tmp_path / "landed"), folders.bronze(spark, str(tmp_path / "in")))
    )
    assert landed == written and sum(landed.values()) == views.raw(obs).count()


def test_an_archive_is_written_as_its_lines_come(tmp_path, monkeypatch):
    """Two partitions that alternate over the batches: an archive each, with all lines in order, the same when repeated."""
    monkeypatch.setattr(folders.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 7))
    batches = [pd.DataFrame({"ano": [2000, 2001, 2000], "semestre": [1, 2, 1], "line": [f"é{i}", f"b{i}", f"c{i}"]}) for i in range(3)]
    for _ in range(2):
        (paths,) = folders.zip_lines(iter(batches), str(tmp_path), 2, "A")
    assert sorted(paths["path"]) == [f"{tmp_path}/ano=2000/semestre=1/2-00007.csv.zip", f"{tmp_path}/ano=2001/semestre=2/2-00007.csv.zip"]
    assert sorted(str(p) for p in tmp_path.rglob("*.zip")) == sorted(paths["path"])
    with zipfile.ZipFile(tmp_path / "ano=2000" / "semestre=1" / "2-00007.csv.zip") as archive:
        assert archive.namelist() == ["leia-me.txt", "dados/2-00007.csv"]
        assert archive.read("dados/2-00007.csv").decode() == "A\né0\nc0\né1\nc1\né2\nc2\n"
