"""Disk that the file jobs take: text is parsed once into a staged table, and only what may be a copy is shuffled."""

import statistics
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from litro.operators import monthly, profiling
from litro.operators.copies import repeated
from litro.plans import bronze_to_silver as job
from litro.plans import profile
from litro.schemas import PARTITION, STATE
from litro.session import dropped_shuffles, stage, work_folder
from litro.sources import delimited
from litro.sources.remote import exists

HEAD = "Estado - Sigla;Municipio;Revenda;CNPJ da Revenda;Complemento;Produto;Data da Coleta;Valor de Venda;Unidade de Medida"


def line(i, extra="", product="GNV"):
    return f"RS;PORTO ALEGRE;POSTO {i};11.222.333/{i:04d}-44;{extra};{product};07/03/2024;5,89;R$ / m3"


def lines_with_copies():
    """Different lines, three of one text, two that differ in a dropped column, blank and malformed ones with a copy each."""
    return [line(i) for i in range(40)] + [line(7)] * 2 + [line(8, "LOJA A")] + [";" * 8] * 3 + [line(1) + ";x", line(1) + ";x"] + [line(2).replace("POSTO", "P�STO")] * 2


def put(root, half, rows, head=HEAD):
    folder = root / "ano=2024" / f"semestre={half}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "dados.csv").write_text("\n".join([head, *rows]) + "\n", encoding="utf-8")


def raw_files(root):
    put(root, 1, lines_with_copies())
    put(root, 2, [f"{i % 2};" + line(i) for i in range(20)] * 2, "Origem;" + HEAD)
    return str(root)


def of_both(spark, root, tmp_path):
    headers = stage(delimited.file_headers(spark, root), work_folder(spark, "headers"))
    return [job.rows_to_stage(spark, root, "*.csv", headers, F.col("ano") == 2024, lines) for lines in (None, str(tmp_path / "lines"))]


def test_staged_lines_give_the_same_rows(spark, tmp_path):
    text, staged = of_both(spark, raw_files(tmp_path / "in"), tmp_path)
    columns = [c for c in text.columns if c != "_linha"]
    got = Counter(map(tuple, staged.select(columns).collect()))
    assert got == Counter(map(tuple, text.select(columns).collect()))
    states = Counter((r.semestre, r[STATE]) for r in staged.collect())
    assert states == {(1, job.IN_ORDER): 41, (1, delimited.SURPLUS): 2, (1, delimited.INVALID): 2, (2, job.IN_ORDER): 20}


def test_rows_without_a_copy_are_written_by_the_task_that_reads_them(spark, tmp_path):
    """No text in the plan, and the part of rows without a copy has no exchange but the map that is broadcast."""
    _, staged = of_both(spark, raw_files(tmp_path / "in"), tmp_path)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan
    alone, others = plan.split("LeftAnti")[1].split("LeftSemi")
    assert "Exchange" not in alone.split("BroadcastExchange")[0] and "REBALANCE" in plan.split("LeftSemi")[0]
    lines = spark.read.parquet(str(tmp_path / "lines"))
    assert lines.count() == 50 + 40 and len(lines.columns) == len(HEAD.split(";")) + 1 + len(PARTITION) + 3


def test_places_are_staged_and_found_again(spark, tmp_path):
    """The map of copies of staged lines is that of the lines themselves."""
    scanned = delimited.scan_bronze(spark, raw_files(tmp_path / "in"), with_state=True)
    staged = delimited.stage_lines(scanned, str(tmp_path / "lines"))
    assert staged.columns[:-1] == scanned.columns
    words = repeated(scanned).collect()
    assert words and sorted(words) == sorted(repeated(staged).collect())
    plan = repeated(staged)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("ReadSchema: ")[1].count(":") == 1  # the place alone is read


def test_the_file_job_parses_text_once_and_stages_it(spark, tmp_path, monkeypatch):
    root, seen = raw_files(tmp_path / "in"), []
    monkeypatch.setattr(job, "stage_lines", lambda raw, target: seen.append(target) or delimited.stage_lines(raw, target))
    with pytest.raises(ValueError, match="'Campos excedentes': 2") as error:
        job.bronze_to_silver(spark, root, str(tmp_path / "silver"))
    assert "'Bytes inválidos': 2" in str(error.value) and "(2024, 2)" not in str(error.value)
    assert len(seen) == 1 and seen[0].endswith("/lines")
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert sorted(tuple(r) for r in silver.select("semestre", "revenda").collect()) == sorted((2, f"POSTO {i}") for i in range(20))


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: sum(f.getName().startswith("shuffle_") for f in (store.getAllFiles().apply(i) for i in range(store.getAllFiles().size())))
    df = spark.range(1000).repartition(4, "id")
    before = shuffles()
    rows = stage(df, str(tmp_path / "t"))
    until = time.time() + 20
    while shuffles() > before and time.time() < until:
        time.sleep(0.2)
    assert shuffles() <= before and rows.count() == 1000
    assert df.groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with dropped_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == was


def test_profile_counts_keys_that_may_repeat(spark, tmp_path, monkeypatch):
    """The profile of staged lines is that of the text; keys of one row are not counted, the text is staged and then deleted."""
    root, seen = raw_files(tmp_path / "in"), []
    scanned = delimited.scan_bronze(spark, root)
    staged = delimited.stage_lines(scanned, str(tmp_path / "lines"))
    text, found = (profiling.counted_values(df, reread) for df, reread in ((scanned, False), (staged, True)))
    order = ["medida", "semestre", "coluna", "valor"]
    rows = [[tuple(r) for r in df.orderBy(*order).collect()] for df in (text, found)]
    several = [r for r in rows[0] if r[0] != profiling.KEY or r[5] > 1]
    assert several == rows[1] and len(several) < len(rows[0])
    keys = {(r.semestre, r.valor.split("/")[1][:4], r.n, r.copias) for r in found.where(F.col("medida") == profiling.KEY).collect()}
    # A line of the invalid bytes has the key of the line it was made from.
    assert {(1, "0007", 3, 2), (1, "0008", 2, 0), (2, "0000", 2, 1)} <= keys
    monkeypatch.setattr(profile, "stage_lines", lambda raw, target: seen.append(target) or delimited.stage_lines(raw, target))
    got, expected = profile.profile_bronze(spark, root), profiling.partition_profile(scanned)
    same = [c for c in expected.columns if c not in ("nulos", "colunas", "total_colunas")]
    assert sorted(map(str, got.select(same).collect())) == sorted(map(str, expected.select(same).collect()))
    assert len(seen) == 1 and not exists(spark, seen[0])


def test_gold_is_shuffled_twice(spark, tmp_path):
    """By place and price, and by the wide key; a price that two spellings of a municipality have is in two rows there."""
    places = [("1", "São Jorge", "RS", "Sul", "SAO JORGE")]
    stage(spark.createDataFrame(places, "codigo_ibge string, municipio string, uf string, regiao string, municipio_match string"), str(tmp_path / "d"))
    prices = [(name, price) for name in ("SAO JORGE", "São Jorge") for price in ("1.00", "3.00", "3.00", "9.00", None)] + [("SAO JORGE", "2.00")] * 4
    rows = [("RS", name, "GNV", price) for name, price in prices]
    silver = spark.createDataFrame(rows, "uf string, municipio string, produto string, valor string")
    silver = silver.select("uf", "municipio", "produto", F.lit("2024-03-07").cast("date").alias("data_coleta"), F.col("valor").cast("decimal(10,2)").alias("valor_venda"))
    gold = monthly.monthly_prices_of_places(silver, spark.read.parquet(str(tmp_path / "d")))
    assert gold._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    row = gold.collect()
    assert len(row) == 1 and (row[0].preco_medio, row[0].preco_mediano, row[0].preco_minimo, row[0].preco_maximo) == (40 / 12, 2.5, 1.0, 9.0)
    known = [1, 3, 3, 9] * 2 + [2] * 4
    assert abs(row[0].desvio_padrao - statistics.stdev(known)) < 1e-12 and row[0].qtd_coletas == 14
