import zipfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from litro.operators import cleaning
from litro.plans import analytics
from litro.plans.bronze_to_silver import bronze_to_silver
from litro.plans.municipalities import build_dimension
from litro.plans.profile import profile_bronze
from litro.plans.silver_to_gold import check_published_gold, silver_to_gold
from litro.schemas import DIMENSION, GOLD, SILVER
from litro.sources import delimited, files, layers
from litro.sources.archives import land_archives
from litro.sources.remote import first_line, open_filesystem
from litro.session import work_folder


def put(root, ano, half, text, name="dados.csv", encoding="utf-8"):
    folder = root / f"ano={ano}" / f"semestre={half}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


HEAD = (
    "Regiao - Sigla;Estado - Sigla;Municipio;Revenda;CNPJ da Revenda;Cep;Produto;"
    "Data da Coleta;Valor de Venda;Unidade de Medida;Bandeira"
)


def line(price="5,89", product="GASOLINA", day="07/03/2024", city="PORTO ALEGRE", state="RS"):
    unit = "R$ / litro"
    return f"S;{state};{city};POSTO;11.222.333/0001-44;90.010-000;{product};{day};{price};{unit};BRANCA"


def test_headers_in_other_orders_are_aligned_by_name(spark, tmp_path):
    put(tmp_path, 2023, 1, "A;B;C\n1;2;3\n")
    put(tmp_path, 2023, 2, "﻿C;A;B\r\n3;1;2\r\n")
    put(tmp_path, 2024, 1, "A;C\n1;3\n")
    put(tmp_path, 2024, 1, "A;B;C;D\n1;2;3;4\n", name="outro.csv")
    put(tmp_path, 2024, 1, "X\n9\n", name="IGNORED.CSV")
    rows = delimited.scan_bronze(spark, str(tmp_path)).collect()
    got = sorted((r.ano, r.semestre, r.A, r.B or "", r.C, r.D or "") for r in rows)
    assert got == [
        (2023, 1, "1", "2", "3", ""),
        (2023, 2, "1", "2", "3", ""),
        (2024, 1, "1", "", "3", ""),
        (2024, 1, "1", "2", "3", "4"),
    ]


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")


def test_one_read_whatever_the_headers(spark, tmp_path):
    """Folders of one header, of two, and of files in the same columns: headers reach the driver, paths don't."""
    for name in ("a.csv", "b.csv"):
        put(tmp_path, 2023, 1, "A;B\n1;2\n", name=name)
    put(tmp_path, 2023, 2, "A\n1\n", name="c d%20é.csv")
    put(tmp_path, 2023, 2, "B;A\n1;\"2\n", name="d.csv")
    put(tmp_path, 2023, 2, "B\n3\n", name="e.csv")
    headers = delimited.file_headers(spark, str(tmp_path))
    assert [s.columns for s in delimited.header_shapes(headers)] == [("A",), ("A", "B"), ("B",), ("B", "A")]
    mixed = delimited.scan_bronze(spark, str(tmp_path), with_state=True)
    assert scans(mixed) == 1
    got = sorted((r.ano, r.semestre, r.A or "", r.B or "") for r in mixed.collect())
    assert got == [(2023, 1, "1", "2"), (2023, 1, "1", "2"), (2023, 2, "", "3"), (2023, 2, "1", ""), (2023, 2, "2", "1")]
    one = delimited.scan_bronze(spark, str(tmp_path), headers=headers.where("semestre = 1"), keep=F.col("semestre") == 1)
    assert scans(one) == 1 and "Join" not in one._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in one.collect()] == [("1", "2", 2023, 1)] * 2


def test_a_file_without_a_known_header_is_an_error(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.csv"):
        put(tmp_path, 2023, 1, f"{name[0]}\n1\n", name=name)
    headers = delimited.file_headers(spark, str(tmp_path)).where("path NOT LIKE '%c.csv'")
    with pytest.raises(Exception, match="No header was read of .*c.csv"):
        delimited.scan_bronze(spark, str(tmp_path), headers=headers).collect()


def test_quotes_blank_lines_and_identifiers(spark, tmp_path):
    put(tmp_path, 2023, 1, 'N;Cep\n"POSTO ""A""; B";01000000\n;\n\n"";007\n')
    got = sorted(
        (r.N or "", r.Cep or "") for r in delimited.scan_bronze(spark, str(tmp_path)).collect()
    )
    assert got == [("", ""), ("", "007"), ('POSTO "A"; B', "01000000")]


def test_line_break_inside_quotes_is_an_option(spark, tmp_path):
    put(tmp_path, 2023, 1, 'N;Cep\n"a\nb";1\n')
    row = delimited.scan_bronze(spark, str(tmp_path), multiLine="true").first()
    assert (row.N, row.Cep) == ("a\nb", "1")


def test_drift_table(spark, tmp_path):
    put(tmp_path, 2023, 1, HEAD + ";Novo\n")
    put(tmp_path, 2023, 2, HEAD.replace("Produto;", "") + "\n")
    drift = delimited.header_drift(delimited.file_headers(spark, str(tmp_path)))
    assert {(r.ano, r.semestre, r.coluna, r.problema) for r in drift.collect()} == {
        (2023, 1, "Novo", "unknown"),
        (2023, 2, "Produto", "missing critical"),
    }


def test_long_headers_and_file_systems(tmp_path):
    (tmp_path / "a%20b.csv").write_text("x" * 200_000 + "\nrest")
    assert len(first_line(f"file:{tmp_path}/a%20b.csv", step=1000)) == 200_000
    (tmp_path / "empty.csv").write_text("")
    assert first_line(str(tmp_path / "empty.csv")) == b""
    assert open_filesystem("file:///tmp/x")[1] == "/tmp/x"


def test_listings(spark, tmp_path):
    put(tmp_path, 2023, 2, "A\n1\n")
    put(tmp_path, 2023, 1, "A\n1\n")
    put(tmp_path, 2023, 1, "x", name="notes.txt")
    root = str(tmp_path)
    paths = [r.path.split(":", 1)[-1] for r in files.discover(spark, root).collect()]
    assert paths == [f"{root}/ano=2023/semestre={h}/dados.csv" for h in (1, 2)]
    meta = {(r.ano, r.semestre) for r in files.partition_metadata(spark, root).collect()}
    assert meta == {(2023, 1), (2023, 2)}
    landed = files.partitions(spark, root, "*.csv")
    done = landed.where("semestre = 1")
    assert [tuple(r)[:2] for r in files.pending(landed, done).collect()] == [(2023, 2)]
    nothing = files.partitions(spark, root + "/absent", "*.parquet")
    assert files.pending(landed, nothing).count() == 2
    gaps = files.coverage_gaps(files.expected_partitions(spark, range(2022, 2024)), landed)
    assert sorted(map(tuple, gaps.collect())) == [(2022, 1), (2022, 2)]


def test_listing_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="Invalid semester"):
        files.expected_partitions(spark, range(2023, 2024), (1, 3))
    (tmp_path / "loose.csv").write_text("A\n1\n")
    with pytest.raises(ValueError, match="No partition folders"):
        files.partition_metadata(spark, str(tmp_path))


def test_missing_inputs_are_errors(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for root in (tmp_path / "absent", tmp_path / "empty"):
        with pytest.raises(FileNotFoundError, match="Silver"):
            layers.read_silver(spark, str(root))
        with pytest.raises(FileNotFoundError, match="dimension"):
            layers.read_dimension(spark, str(root))
        with pytest.raises(FileNotFoundError, match="Gold"):
            layers.read_gold(spark, str(root))


def make_zip(root, ano, half, members):
    folder = root / f"ano={ano}" / f"semestre={half}"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / "pacote.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


def test_archives_need_exactly_one_csv(spark, tmp_path):
    source, bronze = tmp_path / "zip", tmp_path / "bronze"
    make_zip(source, 2023, 1, {"x/preços.csv": "A\n1\n", "leia.txt": "?"})
    make_zip(source, 2023, 2, {"a.csv": "A\n", "b.CSV": "A\n"})
    make_zip(source, 2024, 1, {"leia.txt": "?"})
    make_zip(source, 2024, 2, {"b.CSV": "A\n5\n"})
    (source / "ano=2025" / "semestre=1").mkdir(parents=True)
    (source / "ano=2025" / "semestre=1" / "broken.zip").write_bytes(b"no archive")
    manifest = land_archives(spark, str(source), str(bronze)).collect()
    found = {(r.ano, r.semestre): (r.membros_csv, r.erro is None, r.bytes) for r in manifest}
    assert found == {
        (2023, 1): (1, True, 4),
        (2023, 2): (2, False, None),
        (2024, 1): (0, False, None),
        (2024, 2): (1, True, 4),
        (2025, 1): (0, False, None),
    }
    # An upper-case extension lands as the one that the scan looks for.
    assert sorted(p.name for p in bronze.glob("ano=*/*/*")) == [".b.csv.crc", "b.csv", "preços.csv"][1:]
    again = land_archives(spark, str(source), str(bronze)).collect()
    assert {(r.ano, r.semestre) for r in again} == set(found) - {(2023, 1), (2024, 2)}


def test_members_of_one_name_all_land(spark, tmp_path):
    source, bronze = tmp_path / "zip", tmp_path / "bronze"
    for name, text in (("um", "A\n1\n"), ("dois", "A\n2\n")):
        make_zip(tmp_path / name, 2023, 1, {"p.csv": text})
        folder = source / "ano=2023" / "semestre=1"
        folder.mkdir(parents=True, exist_ok=True)
        made = next((tmp_path / name).rglob("*.zip"))
        (folder / f"{name}.zip").write_bytes(made.read_bytes())
    manifest = land_archives(spark, str(source), str(bronze)).collect()
    assert all(r.erro is None for r in manifest)
    landed = {p.name: p.read_text() for p in bronze.rglob("*.csv")}
    assert landed == {"um__p.csv": "A\n1\n", "dois__p.csv": "A\n2\n"}


def test_a_bad_file_blocks_its_partition_only(spark, tmp_path, raw_row):
    bronze, silver = tmp_path / "bronze", tmp_path / "silver"
    row = raw_row()
    head, line = ";".join(row), ";".join(f'"{v}"' for v in row.values())
    text = {
        1: f"{head}\n{line}\n",
        2: f"{head}\n{line};surplus;fields\n",
        3: f"{head}\n{line}\n".replace("PORTO", "S\xc3O"),
        4: f"{head};{list(row)[0]}\n{line};x\n",
        5: f"{head}\n{';' * (len(row) - 1)}\n",
        6: f"{head}\u00c9\n{line}\n",
    }
    for k, content in text.items():
        folder = bronze / f"ano={2020 + k}" / "semestre=1"
        folder.mkdir(parents=True)
        (folder / "p.csv").write_bytes(content.encode("latin-1" if k in (3, 6) else "utf-8"))
    with pytest.raises(ValueError, match="not published") as problem:
        bronze_to_silver(spark, str(bronze), str(silver))
    said = str(problem.value)
    for part in ("Campos excedentes': 1", "Bytes inválidos': 1", "Colunas repetidas", "Nenhuma linha", "Cabeçalho ilegível"):
        assert part in said
    assert {p.parent.parent.name for p in silver.rglob("*.parquet")} == {"ano=2021"}


def payload(tmp_path):
    state = '"regiao-imediata":{"regiao-intermediaria":{"UF":{"sigla":"%s","regiao":{"nome":"%s"}}}}'
    records = [
        '{"id":4314902,"nome":"Porto Alegre","outro":1,' + state % ("RS", "Sul") + "}",
        '{"id":3530706,"nome":"Mogi Guaçu",' + state % ("SP", "Sudeste") + "}",
    ]
    (tmp_path / "municipios.json").write_text("[" + ",\n".join(records) + "]")
    return str(tmp_path / "municipios.json")


def test_dimension_from_nested_json(spark, tmp_path):
    target = build_dimension(spark, payload(tmp_path), str(tmp_path / "dim"))
    dimension = layers.read_dimension(spark, target)
    assert dimension.schema.names == DIMENSION.names
    assert sorted(map(tuple, dimension.collect())) == [
        ("3530706", "Mogi Guaçu", "SP", "Sudeste", "MOGI GUACU"),
        ("4314902", "Porto Alegre", "RS", "Sul", "PORTO ALEGRE"),
    ]


def test_record_without_region_fails_the_dimension(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"id":1,"nome":"X","regiao-imediata":null}]')
    with pytest.raises(ValueError, match="required_uf"):
        build_dimension(spark, str(tmp_path / "m.json"), str(tmp_path / "dim"))
    assert not (tmp_path / "dim").exists()


def test_whole_chain(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    root = tmp_path / "bronze"
    first = [line("5,10"), line("5,10"), line("5,50"), ";" * 10, line("3,90", "ETANOL")]
    put(root, 2024, 1, "\n".join([HEAD, *first]) + "\n")
    city = line("6,00", day="01/07/2024", city="MOGI GUAÇU", state="SP").removesuffix(";BRANCA")
    put(root, 2024, 2, "\n".join([HEAD.removesuffix(";Bandeira"), city]) + "\n")
    put(root, 2025, 1, HEAD.replace("Produto;", "") + "\n")
    put(root, 2025, 2, "\n".join([HEAD, line("0,00"), line("1,2,3"), line(day="x")]) + "\n")
    with pytest.raises(ValueError, match="not published") as problem:
        bronze_to_silver(spark, bronze, silver)
    assert "Colunas críticas ausentes" in str(problem.value)
    assert "(2025, 2): {'price_positive': 2" in str(problem.value)
    published = files.partitions(spark, silver, layers.PARQUET)
    assert {(r.ano, r.semestre) for r in published.collect()} == {(2024, 1), (2024, 2)}
    rows = layers.read_silver(spark, silver)
    assert rows.columns == SILVER.fieldNames() and rows.count() == 4
    assert rows.where("uf = 'SP'").first().bandeira is None

    # Repaired partitions are picked up; published ones are left alone, whatever their source says.
    put(root, 2024, 1, HEAD + "\n" + line("9,99") + "\n")
    put(root, 2025, 1, HEAD + "\n" + line("6,20", day="02/01/2025") + "\n")
    put(root, 2025, 2, HEAD + "\n" + line("6,30", day="02/08/2025") + "\n")
    assert bronze_to_silver(spark, bronze, silver) == [(2025, 1), (2025, 2)]
    assert bronze_to_silver(spark, bronze, silver) == []
    assert layers.read_silver(spark, silver).where("valor_venda = 9.99").count() == 0

    dimension = build_dimension(spark, payload(tmp_path), str(tmp_path / "dim"))
    years = silver_to_gold(spark, silver, dimension, gold)
    assert [y.rsplit("/", 1)[-1] for y in years] == ["ano=2024", "ano=2025"]
    assert check_published_gold(spark, gold) == 5
    before = sorted(map(str, layers.read_gold(spark, gold).collect()))
    silver_to_gold(spark, silver, dimension, gold)
    assert sorted(map(str, layers.read_gold(spark, gold).collect())) == before

    layers.register_gold_view(spark, gold)
    view = spark.sql("SELECT ano, SUM(qtd_coletas) AS n FROM precos_mensais GROUP BY ano")
    assert {r.ano: r.n for r in view.collect()} == {2024: 4, 2025: 2}
    ratio = analytics.parity(layers.read_gold(spark, gold)).collect()
    assert [(r.municipio, r.razao_etanol_gasolina) for r in ratio] == [("Porto Alegre", 0.736)]


def test_unmatched_place_blocks_gold(spark, tmp_path):
    put(tmp_path / "bronze", 2024, 1, HEAD + "\n" + line(city="CIDADE NOVA") + "\n")
    bronze_to_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    dimension = build_dimension(spark, payload(tmp_path), str(tmp_path / "dim"))
    with pytest.raises(ValueError, match="required_codigo_ibge"):
        silver_to_gold(spark, str(tmp_path / "silver"), dimension, str(tmp_path / "gold"))
    assert not (tmp_path / "gold").exists()


def gold_rows(spark, year, price):
    row = (date(year, 1, 1), "1", "A", "RS", "Sul", "GNV", price, price, price, price, None, 1)
    return spark.createDataFrame([row], GOLD)


def test_publishing_a_year_leaves_others(spark, tmp_path):
    root = str(tmp_path / "gold")
    layers.publish_gold(gold_rows(spark, 2023, 1.0).unionAll(gold_rows(spark, 2024, 1.0)), root)
    assert layers.publish_gold(gold_rows(spark, 2024, 2.0), root) == [f"{root}/ano=2024"]
    got = {r.ano_mes.year: r.preco_medio for r in layers.read_gold(spark, root).collect()}
    assert got == {2023: 1.0, 2024: 2.0}


def test_year_filter_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "gold")
    layers.publish_gold(gold_rows(spark, 2023, 1.0).unionAll(gold_rows(spark, 2024, 1.0)), root)
    one = layers.register_gold_view(spark, root).where("ano = 2024").select("preco_medio")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "ReadSchema: struct<preco_medio:double>" in plan


def test_pivot_needs_unique_cells(spark):
    rows = [("GNV", "Sul", 1.0), ("GNV", "Norte", 2.0), ("ETANOL", "Sul", 3.0)]
    long = spark.createDataFrame(rows, "produto string, regiao string, v double")
    got = analytics.region_matrix(long, "v", ["Norte", "Sul"]).collect()
    assert [tuple(r) for r in got] == [("ETANOL", None, 3.0), ("GNV", 2.0, 1.0)]
    assert sorted(analytics.region_matrix(long, "v", None).columns) == ["Norte", "Sul", "produto"]
    with pytest.raises(Exception, match="More than one value"):
        analytics.region_matrix(long.unionAll(long), "v", ["Norte", "Sul"]).collect()
    with pytest.raises(Exception, match="Region outside the list: Norte"):
        analytics.region_matrix(long, "v", ["Sul"]).collect()
    lost = spark.createDataFrame([("GNV", None, 1.0)], long.schema)
    with pytest.raises(Exception, match="Region outside the list: null"):
        analytics.region_matrix(lost, "v", ["Sul"]).collect()


def test_parity_share_uses_the_rounded_ratio(spark):
    def month(n, ethanol, gasoline):
        return [
            (date(2024, n, 1), "1", "A", "RS", "Sul", p, v, v, v, v, None, 1)
            for p, v in (("ETANOL", ethanol), ("GASOLINA", gasoline))
        ]

    rows = month(1, 0.6996, 1.0) + month(2, 0.6994, 1.0) + month(3, 0.5, 1.0)
    lonely = [(date(2024, 4, 1), "1", "A", "RS", "Sul", "ETANOL", 1.0, 1.0, 1.0, 1.0, None, 1)]
    gold = spark.createDataFrame(rows + lonely, GOLD)
    total = analytics.parity_share(analytics.parity(gold)).first()
    assert tuple(total) == (3, 2, 66.67)
    none = analytics.parity_share(analytics.parity(gold.where("produto = 'ETANOL'"))).first()
    assert tuple(none) == (0, 0, None)


def test_working_folder_is_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", "/"))
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_decimal_survives_the_layers(spark, tmp_path):
    row = ("S", "RS", "A", None, "1" * 14, None, "GNV", date(2024, 1, 1), Decimal("0.01"), "u", None)
    df = spark.createDataFrame([row], SILVER).withColumns({"ano": F.lit(2024), "semestre": F.lit(1)})
    layers.publish_silver(df, str(tmp_path / "s"))
    assert layers.read_silver(spark, str(tmp_path / "s")).first().valor_venda == Decimal("0.01")


def test_sql_users_keep_their_queries(spark, tmp_path):
    """View over files, query on the view, its result as a view, query on that."""
    root = str(tmp_path / "gold")
    pairs = [("ETANOL", 3.5), ("GASOLINA", 5.0), ("GNV", 4.0)]
    rows = [(date(2024, 1, 1), "1", "A", "RS", "Sul", p, v, v, v, v, 0.5, 2) for p, v in pairs]
    layers.publish_gold(spark.createDataFrame(rows, GOLD), root)
    layers.register_gold_view(spark, root, "prices")
    spark.sql(
        "SELECT e.regiao, ROUND(e.preco_medio / g.preco_medio, 3) AS ratio FROM prices AS e "
        "INNER JOIN prices AS g ON e.ano_mes = g.ano_mes AND e.codigo_ibge = g.codigo_ibge "
        "WHERE e.produto = 'ETANOL' AND g.produto = 'GASOLINA'"
    ).createOrReplaceTempView("ratios")
    got = spark.sql(
        "SELECT regiao, COUNT(*) AS total, COUNT(*) FILTER (WHERE ratio < 0.75) AS low, "
        "ROUND(100.0 * COUNT(*) FILTER (WHERE ratio < 0.75) / COUNT(*), 2) AS share "
        "FROM ratios GROUP BY regiao ORDER BY share DESC"
    ).first()
    assert (got.regiao, got.total, got.low, float(got.share)) == ("Sul", 1, 1, 100.0)


def test_profile_keeps_to_each_files_own_columns(spark, tmp_path):
    put(tmp_path, 2024, 1, "\n".join([HEAD, line(), line(), line("6,00")]) + "\n")
    short = HEAD.removesuffix(";Bandeira") + ";Novo"
    put(tmp_path, 2024, 2, short + "\n" + line().removesuffix(";BRANCA") + ";\n")
    rows = {r.semestre: r for r in profile_bronze(spark, str(tmp_path)).collect()}
    assert rows[1].colunas == HEAD.split(";") and rows[1].nulos == {}
    assert (rows[1].total_linhas, rows[1].duplicatas_exatas) == (3, 1)
    assert rows[1].colisoes_chave_candidata == 1
    assert rows[2].colunas == short.split(";") and rows[2].total_colunas == 11
    assert rows[2].nulos == {"Novo": 1}


def test_unnamed_columns_and_empty_files(spark, tmp_path):
    put(tmp_path, 2024, 1, HEAD + ";\n" + line() + ";x\n")
    raw = delimited.scan_bronze(spark, str(tmp_path))
    assert "_c11" in raw.columns and raw.first()["_c11"] == "x"
    assert cleaning.to_silver(raw).count() == 1
    put(tmp_path, 2024, 2, "\n")
    with pytest.raises(ValueError, match="without a header"):
        delimited.scan_bronze(spark, str(tmp_path))
    with pytest.raises(ValueError, match="Colunas críticas ausentes"):
        bronze_to_silver(spark, str(tmp_path), str(tmp_path / "silver"))
    done = files.partitions(spark, str(tmp_path / "silver"), layers.PARQUET).collect()
    assert [(r.ano, r.semestre) for r in done] == [(2024, 1)]


def test_two_shuffles_from_text_to_staged_silver(spark, tmp_path):
    """One finds copies, one deals out the rows by partition; headers are joined without one."""
    from litro.plans.bronze_to_silver import rows_to_stage
    from litro.session import stage

    put(tmp_path, 2024, 1, HEAD + "\n" + line() + "\n")
    put(tmp_path, 2024, 2, HEAD.removesuffix(";Bandeira") + "\n" + line().removesuffix(";BRANCA") + "\n")
    headers = stage(delimited.file_headers(spark, str(tmp_path)), work_folder(spark, "headers"))
    rows = rows_to_stage(spark, str(tmp_path), "*.csv", headers, F.col("ano") == 2024)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert plan.count("+- Exchange") + plan.count("+- BroadcastExchange") == 3 and "BroadcastHashJoin" in plan
    assert plan.count("REBALANCE") == 1


def test_inputs_report(spark, tmp_path):
    put(tmp_path, 2024, 1, "A\n")
    put(tmp_path, 2024, 1, "A\n", name="b.csv")
    put(tmp_path, 2024, 2, "A\n")
    places = {"csv": (str(tmp_path), "*.csv"), "zip": (str(tmp_path), "*.zip"), "gold": (str(tmp_path / "none"), "*.parquet")}
    got = {tuple(r) for r in files.inputs_report(spark, places).collect()}
    assert got == {("csv", True, 2), ("zip", False, 0), ("gold", False, 0)}


def test_profile_values_and_lists(spark, tmp_path):
    from litro.operators import profiling
    from litro.plans.profile import bronze_values

    days = [f"{d:02d}/01/2024" for d in (3, 1, 2)]
    rows = [line(day=d, product=p) for d in days for p in ("GNV", "ETANOL", "")] + [line(day="31/02/2024"), line(day=""), line(day="01/01/2024", product="GNV")]
    put(tmp_path, 2024, 1, "\n".join([HEAD, *rows]) + "\n")
    values = {(r.coluna, r.valor): r.n for r in bronze_values(spark, str(tmp_path)).collect()}
    assert values["Produto", None] == 3 and values["Produto", "GNV"] == 4 and values["Data da Coleta", None] == 1
    profile = profile_bronze(spark, str(tmp_path)).first()
    assert profile.produtos == [None, "ETANOL", "GASOLINA", "GNV"]
    assert (profile.data_minima, profile.data_maxima, profile.datas_ilegiveis) == (date(2024, 1, 1), date(2024, 1, 3), 1)
    assert (profile.total_linhas, profile.duplicatas_exatas, profile.colisoes_chave_candidata) == (12, 1, 1)
    assert profile.nulos == {"Produto": 3, "Data da Coleta": 1}
    counted = profiling.counted_values(delimited.scan_bronze(spark, str(tmp_path)))
    assert profiling.value_lists(counted, ["Produto"], most=2).first()["Produto"] == [None, "ETANOL"]
    assert scans(counted) == 1
