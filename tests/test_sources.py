from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from feira.schemas import ENTITIES, MissingColumnsError, select_required
from feira.sources import files, generator, jdbc, landing, selection


def test_read_entity_csv(spark, rows, tmp_path):
    path = tmp_path / "clientes.csv"
    # Columns in another order, one too many, an accent, a bad date and a short row.
    path.write_text(
        "extra,id,nome,email,distrito,data_registo\n"
        "x,1,Inês Gonçalves,ines@exemplo.pt,Évora,2025-01-05\n"
        "x,2,\"Silva, Rui\",rui@exemplo.pt,Porto,someday\n"
        "x,3,Ana\n", encoding="utf-8",
    )
    df = files.read_entity_csv(spark, str(path), "clientes")
    assert df.schema == ENTITIES["clientes"]
    assert rows(df) == [
        (1, "Inês Gonçalves", "ines@exemplo.pt", date(2025, 1, 5), "Évora"),
        (2, "Silva, Rui", "rui@exemplo.pt", None, "Porto"),
        (3, "Ana", None, None, None),
    ]


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_entity_csv(spark, str(tmp_path / "none.csv"), "clientes")
    (tmp_path / "produtos.csv").write_text("id,nome\n1,x\n")
    with pytest.raises(MissingColumnsError, match="categoria.*fornecedor.*preco"):
        files.read_entity_csv(spark, str(tmp_path / "produtos.csv"), "produtos")


def test_select_required_drops_extras(spark):
    df = spark.createDataFrame([(1, "n", "c", "1.0", "f", "z")], "id long, nome string, categoria string, preco string, fornecedor string, z string")
    assert select_required(df, "produtos").columns == ENTITIES["produtos"].names


def test_generated_data_round_trips_as_csv(spark, rows, tmp_path):
    made = generator.generate(spark, customers=50, products=20, transactions=200, seed=5, now=datetime(2025, 6, 1))
    for table, df in made.items():
        files.write_csv(files.raw_text(df, table), str(tmp_path / f"{table}.csv"))
    back = files.read_csv_folder(spark, str(tmp_path))
    assert {t: df.count() for t, df in back.items()} == {
        "clientes": 50, "produtos": 20, "transacoes": 200, "transacao_itens": 200,
    }
    assert rows(back["produtos"]) == rows(made["produtos"].select(*ENTITIES["produtos"].names))


def test_generator_values(spark, rows):
    made = generator.generate(spark, seed=1, now=datetime(2025, 6, 1))
    assert made["clientes"].select("email").distinct().count() == 1000
    assert made["clientes"].where(~F.col("email").rlike(r"^[^ A-Z]+\.\d+@exemplo\.pt$")).isEmpty()
    low, high, n = made["produtos"].agg(F.min("preco"), F.max("preco"), F.count("*")).first()
    assert D("5.00") <= low < high <= D("500.00") and n == 500
    assert made["transacoes"].agg(F.min("quantidade"), F.max("quantidade")).first() == (1, 5)
    oldest, newest = made["transacoes"].agg(F.min("data_hora"), F.max("data_hora")).first()
    assert datetime(2024, 6, 1) <= oldest < newest <= datetime(2025, 6, 1)
    itens = made["transacao_itens"]
    assert itens.count() == 5000
    wrong = itens.join(made["produtos"].withColumnRenamed("id", "id_produto"), "id_produto").where("preco <> preco_unitario")
    assert wrong.isEmpty()
    again = generator.generate(spark, seed=1, now=datetime(2025, 6, 1))
    assert rows(again["produtos"]) == rows(made["produtos"])
    assert rows(generator.generate(spark, seed=2, now=datetime(2025, 6, 1))["produtos"]) != rows(made["produtos"])


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "clientes", "loja")
    assert plain["dbtable"] == "loja.clientes" and "partitionColumn" not in plain
    split = jdbc.jdbc_options("jdbc:x", "clientes", bounds=(1, 100), partitions=4, user="u")
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4" and split["user"] == "u"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "100")


def test_fact_source(spark):
    one = {name: spark.range(1) for name in selection.FACT_INPUTS}
    two = {name: spark.range(2) for name in selection.FACT_INPUTS}
    assert [df.count() for df in selection.select_fact_source("DEV", one, two)] == [1, 1, 1]
    assert [df.count() for df in selection.select_fact_source("prod", one, two)] == [2, 2, 2]
    assert [df.count() for df in selection.select_fact_source(None, one, two)] == [2, 2, 2]
    with pytest.raises(selection.MissingSourceError, match="transacao_itens"):
        selection.select_fact_source("dev", {"transacoes": one["transacoes"]}, two, landed=one)
    with pytest.raises(selection.MissingSourceError, match="database"):
        selection.select_fact_source("prod", one, {})


def test_partition_path(spark):
    assert landing.partition_path(date(2025, 3, 7)) == "raw/year=2025/month=03/day=07"
    assert landing.version_tag(datetime(2025, 10, 24, 15, 25, 30)) == "20251024T152530Z"
    df = spark.createDataFrame([(date(2025, 3, 7),)], "d date")
    assert df.select(landing.partition_path_column(F.col("d"))).first()[0] == "raw/year=2025/month=03/day=07"


def test_landing_versions(spark, rows, tmp_path):
    root, day = str(tmp_path), date(2025, 3, 7)

    def delivery(name):
        return {t: spark.createDataFrame([("1", name)], "id string, nome string") for t in landing.LANDED}

    landing.land(delivery("old"), root, day, "20250307T080000Z")
    landing.land(delivery("new"), root, day, "20250307T090000Z")
    landing.land(delivery("new"), root, day, "20250307T090000Z")  # retried
    headers = {t: ["id", "nome"] for t in landing.LANDED}
    assert rows(landing.read_landed_day(spark, root, day, headers)["produtos"]) == [("1", "new")]
    assert rows(landing.read_landed_day(spark, root, day, headers, pick="first")["produtos"]) == [("1", "old")]
    assert (tmp_path / "raw/year=2025/month=03/day=07/customers/version=20250307T080000Z").is_dir()
    with pytest.raises(FileNotFoundError):
        landing.read_landed_day(spark, root, date(2025, 3, 8), headers)
    with pytest.raises(FileNotFoundError):
        landing.land({}, root, day)


def test_csv_keeps_quotes_commas_blanks_and_line_ends(spark, rows, tmp_path):
    path = str(tmp_path / "produtos.csv")
    names = ['TV 12" wide, black', " Ana ", "a\\b", 'he said ""', "é;|"]
    df = spark.createDataFrame([(i, n, "c", 1, "f") for i, n in enumerate(names)], "id int, nome string, categoria string, preco int, fornecedor string")
    files.write_csv(files.raw_text(df, "produtos"), path)
    assert rows(files.read_entity_csv(spark, path, "produtos"), "id", "nome") == list(enumerate(names))
    lines = str(tmp_path / "lines.csv")
    files.write_csv(files.raw_text(df.withColumn("nome", F.lit("two\nlines")), "produtos"), lines)
    got = files.read_entity_csv(spark, lines, "produtos", multi_line=True)
    assert {r.nome for r in got.collect()} == {"two\nlines"} and got.count() == len(names)


def test_csv_with_lines_of_the_wrong_width_raises(spark, tmp_path):
    (tmp_path / "produtos.csv").write_text("id,nome,categoria,preco,fornecedor\n1,a,b,2.5,c\n2,x\n")
    with pytest.raises(Exception, match="malformed line"):
        files.read_entity_csv(spark, str(tmp_path / "produtos.csv"), "produtos").collect()


def test_landed_text_comes_back_whole(spark, rows, tmp_path):
    names = ['a "quoted", name', " blank "]
    tables = {n: spark.createDataFrame([("1", x) for x in names], "id string, nome string") for n in landing.LANDED}
    landing.land(tables, str(tmp_path), date(2025, 1, 1), "v1")
    for name in landing.LANDED:
        assert rows(landing.read_landed(spark, str(tmp_path), date(2025, 1, 1), name, ["id", "nome"]), "nome") == sorted((n,) for n in names)


def test_landed_columns_go_by_the_header(spark, tmp_path):
    """Versions may name their columns in any order, and have more of them."""
    day, header = date(2025, 10, 26), ["id", "nome"]
    for version, columns in (("20251026T090000Z", ["id", "nome"]), ("20251026T100000Z", ["extra", "nome", "id"])):
        rows = spark.createDataFrame([("1", "Ana", "x")], "id string, nome string, extra string").select(*columns)
        landing.land(dict.fromkeys(landing.LANDED, rows), str(tmp_path), day, version)
    for pick in ("first", "last"):
        got = landing.read_landed(spark, str(tmp_path), day, "clientes", header, pick)
        assert got.columns == header and [tuple(r) for r in got.collect()] == [("1", "Ana")]
    with pytest.raises(MissingColumnsError, match="distrito"):
        landing.read_landed(spark, str(tmp_path), day, "clientes", ["id", "distrito"])
    with pytest.raises(FileNotFoundError):
        landing.read_landed(spark, str(tmp_path), date(2025, 10, 27), "clientes", header)
