from datetime import datetime

import pytest

from feira.operators import constraints, expectations, row_rules
from feira.plans import quality_gate
from feira.schemas import RAW_HEADERS
from feira.sources import lines


def raw(spark, table, *records):
    header = RAW_HEADERS[table]
    return spark.createDataFrame([tuple(r) for r in records], ", ".join(f"{c} string" for c in header))


def found(df):
    return sorted((r.chave, r.regra, r.coluna) for r in df.collect())


def test_customer_rules(spark):
    df = raw(
        spark, "clientes", ("1", "Ana", "ana@x.pt", "2025-01-05", "Porto"),
        ("2", "", "nobody", "05/01/2025", "Porto"), ("3", "Eva", None, "", "Faro"),
    )
    assert found(row_rules.violations("clientes", df)) == [
        ("2", "invalid date", "data_registo"), ("2", "invalid email", "email"), ("2", "null value", "nome"),
        ("3", "invalid date", "data_registo"), ("3", "invalid email", "email"),
        ("3", "null value", "data_registo"), ("3", "null value", "email"),
    ]


def test_price_rules(spark):
    prices = ["9.99", "", "nan", "inf", "0", "-2", " 7.5 ", "x"]
    df = raw(spark, "produtos", *[(str(i), "n", "c", p, "f") for i, p in enumerate(prices)])
    assert found(row_rules.violations("produtos", df)) == [
        ("1", "invalid price", "preco"), ("1", "null value", "preco"),
        ("4", "non-positive price", "preco"), ("5", "non-positive price", "preco"), ("7", "invalid price", "preco"),
    ]


def test_transaction_and_item_rules(spark):
    t = raw(spark, "transacoes", ("1", "1", "1", "1", "2025-10-26 19:30:45", "m"), ("2", "1", "1", "1", "later", "m"))
    assert found(row_rules.violations("transacoes", t)) == [("2", "invalid timestamp", "data_hora")]
    i = raw(
        spark, "transacao_itens", ("1", "1", "1", " 2 ", "1.0"), ("2", "1", "1", "3.0", "0"), ("3", "1", "1", "0", "free"),
    )
    assert found(row_rules.violations("transacao_itens", i)) == [
        ("2", "invalid quantity", "quantidade"), ("2", "non-positive unit price", "preco_unitario"),
        ("3", "invalid unit price", "preco_unitario"), ("3", "non-positive quantity", "quantidade"),
    ]
    assert [r.id for r in i.where(row_rules.valid_rows("transacao_itens", i)).collect()] == ["1"]


def dirty_tables(spark):
    return {
        "clientes": spark.createDataFrame([(1, "a@b.pt"), (2, None), (None, "no at")], "id long, email string"),
        "produtos": spark.createDataFrame([(1, 1.0), (2, None), (3, 0.0)], "id long, preco double"),
        "transacoes": spark.createDataFrame(
            [(1, 1, "2025-01-01"), (2, None, None), (3, 1, "soon")], "id long, id_cliente long, data_hora string"
        ),
        "transacao_itens": spark.createDataFrame(
            [(1, 1, 1, 1, 1.0), (2, 1, 1, -1, 0.0)],
            "id long, id_transacao long, id_produto long, quantidade int, preco_unitario double",
        ),
    }


def test_expectations(spark):
    results = expectations.check_tables(dirty_tables(spark))
    failing = {(r.tabela, r.regra, r.coluna): r.linhas_falhadas for r in results.collect() if r.linhas_falhadas}
    assert failing == {
        ("clientes", "not_null", "id"): 1,
        ("clientes", "not_null", "email"): 1,
        ("clientes", "email", "email"): 2,  # a missing e-mail breaks both rules
        ("produtos", "not_null", "preco"): 1,
        ("produtos", "positive", "preco"): 1,  # a missing price is not non-positive
        ("transacoes", "not_null", "id_cliente"): 1,
        ("transacoes", "not_null", "data_hora"): 1,
        ("transacoes", "timestamp", "data_hora"): 2,
        ("transacao_itens", "positive", "quantidade"): 1,
        ("transacao_itens", "positive", "preco_unitario"): 1,
    }
    assert expectations.total_issues(results).first()[0] == 10


def test_gate(spark, tmp_path):
    report = str(tmp_path / "report")
    with pytest.raises(quality_gate.DataQualityError, match="10 issues"):
        quality_gate.run_gate(dirty_tables(spark), report)
    text = spark.read.text(report, wholetext=True).where("value <> ''").first()[0]
    assert "**Total issues:** 10" in text
    assert "- ❌ Invalid email addresses in 'email' (2 rows)" in text
    clean = {name: df.limit(0) for name, df in dirty_tables(spark).items()}
    results = quality_gate.run_gate(clean)
    text = quality_gate.render_report(results, "prod", "somewhere", datetime(2025, 10, 27))
    assert text.count("✅ No issues found") == 4
    assert "- Environment: **prod**" in text and "**Total issues:** 0" in text


def test_constraints(spark, rows):
    tables = {
        "clientes": spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id long, email string"),
        "produtos": spark.createDataFrame([(1,), (1,)], "id long"),
        "transacoes": spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id long, id_cliente long"),
    }
    assert rows(constraints.broken_constraints(tables)) == [
        ("clientes", "unique(email)", "a", 2),
        ("produtos", "unique(id)", "1", 2),
        ("transacoes", "foreign key(id_cliente)", "9", 2),
    ]


def test_validate_folder_reports_missing_files(spark, tmp_path):
    for table in ("clientes", "produtos", "transacoes"):
        (tmp_path / f"{table}.csv").write_text(
            ",".join(RAW_HEADERS[table]) + "\n" + ("1,n,c,-1,f\n" if table == "produtos" else "")
        )
    out = str(tmp_path / "violations")
    for _ in range(2):  # the log is replaced, not extended
        status = quality_gate.validate_folder(spark, str(tmp_path), out)
    assert status == {
        "clientes.csv": "finished", "produtos.csv": "finished", "transacoes.csv": "finished",
        "transacao_itens.csv": "not found",
    }
    assert [(r.chave, r.regra) for r in spark.read.parquet(out).collect()] == [("1", "non-positive price")]


def test_violations_go_by_the_header(spark, tmp_path):
    (tmp_path / "produtos.csv").write_text("id,nome,preco,categoria,fornecedor\n1,a,2.5,Casa,c\n2,b,-1,Casa,c\n")
    out = str(tmp_path / "out")
    quality_gate.validate_folder(spark, str(tmp_path), out)
    assert [(r.chave, r.regra) for r in spark.read.parquet(out).collect()] == [("2", "non-positive price")]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    """One file read in many splits, with blank lines, and others beside it."""
    folder = tmp_path / "f"
    folder.mkdir()
    big = ["id,email"] + [f"{i},{'x' * (i % 90)}" for i in range(1, 4000)]
    (folder / "a.csv").write_text("\n\n".join(big) + "\n")
    (folder / "b.csv").write_bytes(b"id,email\r\n1,a\r\n\r\n2,b")
    (folder / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = lines.read_numbered_csv(spark, str(folder))
        assert read.rdd.getNumPartitions() > 8
        got = {(r["_ficheiro"][-5:], int(r["id"])): r["_linha"] for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {("a.csv", i): i for i in range(1, 4000)} | {("b.csv", 1): 1, ("b.csv", 2): 2}


def test_lines_are_numbered_over_pieces(spark, tmp_path):
    """A file that many tasks wrote: only its first piece is headed, and numbers run on."""
    big = ["id,email"] + [f"{i},{'x' * (i % 90)}" for i in range(1, 4000)]
    for part in ("p=1 a", "p=2"):
        (tmp_path / "f" / part).mkdir(parents=True)
        for k, (lo, hi) in enumerate([(0, 3), (3, 2500), (2500, 2501), (2501, 4000)]):
            (tmp_path / "f" / part / f"part-0000{k}.txt").write_text("\n\n".join(big[lo:hi]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = [(r["_ficheiro"].split("/")[-2][:3], int(r["id"]), r["_linha"]) for r in lines.read_numbered_csv(spark, str(tmp_path / "f"), pieces=True).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == [(p, i, i) for p in ("p=1", "p=2") for i in range(1, 4000)]


def test_files_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """Each task sorts and writes a bounded number of lines; the pieces together are one file."""
    from feira import queries

    monkeypatch.setattr(queries, "PIECE_ROWS", 500)
    queries._write_dirty_files(spark, "/root/testdata/sf0.001", str(tmp_path))
    for part in (tmp_path / "transacao_itens.csv").iterdir():
        if part.is_dir():
            sizes, keys = [], []
            for piece in sorted(part.glob("*.txt")):
                found = piece.read_text().splitlines()
                sizes.append(len(found))
                keys += [line.split(",")[0] for line in found]
            assert keys[0] == "id" and "id" not in keys[1:] and keys[1:] == sorted(keys[1:], key=int)
            assert max(sizes) < 1500 and (len(keys) < 1500 or len(sizes) > 1)


def test_wide_and_narrow_lines_are_violations(spark, tmp_path):
    (tmp_path / "produtos.csv").write_text(
        'nome,id,categoria,preco,fornecedor\n"a, ""b""",1,c,1.5,f\nx,2,c,1.5,f,more\n\ny,3,c,1.5\nz,4,,0,f\n')
    out = str(tmp_path / "out")
    status = quality_gate.validate_folder(spark, str(tmp_path), out)
    assert status["produtos.csv"] == "finished" and status["clientes.csv"] == "not found"
    found = spark.read.parquet(out).select("linha", "chave", "regra", "coluna", "valor").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([
        (2, "2", "wrong number of fields", None, "x,2,c,1.5,f,more"), (3, "3", "wrong number of fields", None, "y,3,c,1.5"),
        (3, "3", "null value", "fornecedor", None), (4, "4", "null value", "categoria", None),
        (4, "4", "non-positive price", "preco", "0"),
    ], key=repr)


@pytest.mark.parametrize("map_bytes", [constraints.MAP_BYTES, 0])
def test_breaches_of_all_kinds(spark, rows, monkeypatch, capsys, map_bytes):
    """The same with maps of keys and with joins; hot, negative and far-off keys."""
    monkeypatch.setattr(constraints, "MAP_BYTES", map_bytes)
    tables = {
        "clientes": spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (-5, "b"), (0, "c")], "id long, email string"),
        "produtos": spark.createDataFrame([(1, 1.0), (1, None), (32768, 2.0), (32769, 2.0)], "id long, preco double"),
        "transacoes": spark.createDataFrame(
            [(1, 1), (2, 9), (3, 9), (4, None), (5, -5), (6, 0), (7, -6), (8, 2**60)], "id long, id_cliente long"),
        "transacao_itens": spark.createDataFrame(
            [(i, 1, 32768) for i in range(50)] + [(50, 99, 32770), (51, 99, None), (None, 8, 32769)],
            "id long, id_transacao long, id_produto long"),
    }
    found = constraints.breaches(tables)
    assert rows(found) == sorted([
        ("clientes", "unique(email)", "a", 2), ("clientes", "not null(email)", None, 1), ("produtos", "unique(id)", "1", 2),
        ("produtos", "not null(preco)", None, 1), ("transacoes", "not null(id_cliente)", None, 1),
        ("transacoes", "foreign key(id_cliente)", "9", 2), ("transacoes", "foreign key(id_cliente)", "-6", 1),
        ("transacoes", "foreign key(id_cliente)", str(2**60), 1), ("transacao_itens", "not null(id)", None, 1),
        ("transacao_itens", "not null(id_produto)", None, 1), ("transacao_itens", "foreign key(id_transacao)", "99", 2),
        ("transacao_itens", "foreign key(id_produto)", "32770", 1),
    ], key=repr)
    constraints.breaches({t: tables[t] for t in ("clientes", "transacoes")}).explain()
    assert map_bytes == 0 or "SortMergeJoin" not in capsys.readouterr().out
