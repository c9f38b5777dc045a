from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from feira.plans import backfill, compaction, lake, loader, measured, tables, warehouse
from feira.plans.quality_gate import DataQualityError
from feira.sources import files, generator


@pytest.fixture(scope="module")
def made(spark):
    return generator.generate(spark, customers=30, products=15, transactions=120, seed=9, now=datetime(2025, 6, 1))


def test_load_folder_twice(spark, rows, made, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "db")
    for table, df in made.items():
        files.write_csv(files.raw_text(df, table), f"{raw}/{table}.csv")
    loader.load_folder(spark, raw, root)
    first = rows(tables.read_table(spark, f"{root}/produtos").drop("version_timestamp"))
    audit = loader.load_folder(spark, raw, root)
    assert rows(tables.read_table(spark, f"{root}/produtos").drop("version_timestamp")) == first
    assert audit.count() == 8
    assert rows(audit.where("tabela = 'transacoes'"), "ficheiro", "linhas_carregadas", "sucesso", "erro") == [
        ("transacoes.csv", 120, True, None)
    ] * 2
    assert audit.where("data_fim < data_inicio").isEmpty()


def test_one_failing_table_does_not_stop_the_others(spark, made, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "db")
    for table in ("produtos", "transacoes", "transacao_itens"):
        files.write_csv(files.raw_text(made[table], table), f"{raw}/{table}.csv")
    with pytest.raises(loader.LoadError, match="clientes"):
        loader.load_folder(spark, raw, root)
    audit = {r.tabela: r for r in loader.read_audit(spark, root).collect()}
    assert not audit["clientes"].sucesso and "clientes.csv" in audit["clientes"].erro
    assert audit["produtos"].sucesso and audit["produtos"].linhas_carregadas == 15


def test_load_rules(spark, made, tmp_path):
    batch = made["produtos"]
    assert loader.load_table(batch.limit(0), "produtos", str(tmp_path)) == 0
    assert tables.read_table(spark, str(tmp_path / "produtos")) is None
    with pytest.raises(loader.DuplicateKeyError):
        loader.load_table(batch.unionByName(batch.limit(1)), "produtos", str(tmp_path))
    with pytest.raises(loader.DuplicateKeyError):
        loader.load_table(batch.withColumn("id", F.lit(None).cast("long")).limit(1), "produtos", str(tmp_path))


@pytest.mark.parametrize("table, column, value, reason", [
    ("produtos", "preco", "abc", "preco"), ("produtos", "nome", None, "nome"), ("transacoes", "id_cliente", "zz", "id_cliente"),
    ("transacao_itens", "quantidade", "3.0", "quantidade"), ("clientes", "email", "same@x.pt", "email"),
    ("clientes", "data_registo", "26/10/2025", "data_registo"),
])
def test_bad_tables_are_refused_whole(spark, made, tmp_path, table, column, value, reason):
    bad = made[table].withColumn(column, F.lit(value).cast("string"))
    with pytest.raises(loader.LoadError):
        loader.load_all(spark, {table: lambda: bad}, str(tmp_path))
    audit = loader.read_audit(spark, str(tmp_path)).first()
    assert not audit.sucesso and audit.linhas_carregadas == 0 and f"{reason}: " in audit.erro
    assert tables.read_table(spark, str(tmp_path / table)) is None


def test_an_email_of_another_customer_is_refused(spark, made, tmp_path):
    one = made["clientes"].where("id = 1")
    loader.load_table(loader.conform(one, "clientes"), "clientes", str(tmp_path))
    loader.load_table(loader.conform(one, "clientes"), "clientes", str(tmp_path))
    with pytest.raises(loader.RejectedBatchError, match="email"):
        loader.load_table(loader.conform(one.withColumn("id", F.lit(2)), "clientes"), "clientes", str(tmp_path))


def test_warehouse_is_replaced_not_extended(spark, rows, made, tmp_path):
    root = str(tmp_path)
    args = made["transacoes"], made["transacao_itens"], made["produtos"]
    first = warehouse.build_warehouse(*args, root, datetime(2025, 1, 1))
    second = warehouse.build_warehouse(*args, root, datetime(2025, 2, 1))
    assert first == second
    assert first["dim_products"] == 15
    revenue = args[1].join(args[2].select(F.col("id").alias("id_produto"), "preco"), "id_produto").agg(
        F.sum(F.col("quantidade") * F.col("preco"))
    ).first()[0]
    for table, column in {
        "dim_customer_value": "customer_lifetime_value", "fact_daily_sales": "daily_revenue",
        "fact_weekly_sales": "weekly_revenue", "fact_monthly_sales": "monthly_revenue",
    }.items():
        assert warehouse.read_warehouse(spark, root, table).agg(F.sum(column)).first()[0] == revenue


def test_a_failed_build_changes_nothing_that_readers_see(spark, rows, made, tmp_path, monkeypatch):
    root, args = str(tmp_path), (made["transacoes"], made["transacao_itens"], made["produtos"])
    warehouse.build_warehouse(*args, root, datetime(2025, 1, 1))
    tables_of = lambda: {t: rows(warehouse.read_warehouse(spark, root, t)) for t in (
        "dim_products", "dim_customer_value", "fact_recommendations", "fact_daily_sales")}
    before, metrics = tables_of(), rows(warehouse.run_metrics(spark, root))
    more = args[1].withColumn("quantidade", F.col("quantidade") + 1)
    dearer = args[2].withColumn("preco", (F.col("preco") + 1).cast("decimal(10,2)"))
    monkeypatch.setattr(warehouse, "append_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.build_warehouse(args[0], more, dearer, root, datetime(2025, 1, 2))
    assert tables_of() == before and rows(warehouse.run_metrics(spark, root)) == metrics
    monkeypatch.undo()
    written = warehouse.build_warehouse(args[0], more, dearer, root, datetime(2025, 1, 3))
    assert written["dim_products"] == 30  # new versions and those they close
    assert warehouse.read_warehouse(spark, root, "dim_products").where("is_current").count() == 15
    last = {r.table_name: r for r in warehouse.run_metrics(spark, root).where("run = 1").collect()}
    assert {t: r.n_rows for t, r in last.items()} == written
    assert last["dim_products"].nulls["end_date"] == 15 and all(r.seconds > 0 for r in last.values())


def test_a_write_measures_itself(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=7).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("a b"))
    m = measured.measured_write(df, "t", lambda w: w.write.format("noop").mode("overwrite").save())
    assert (m.table_name, m.n_rows, m.nulls) == ("t", 1000, {"id": 0, "a b": 250}) and m.seconds > 0
    none = measured.measured_write(df.limit(0), "u", lambda w: w.write.parquet(str(tmp_path / "u")))
    assert (none.n_rows, none.nulls) == (0, {"id": 0, "a b": 0})


def test_backfill(spark, rows, tmp_path):
    transacoes = spark.createDataFrame(
        [(1, 1, datetime(2025, 1, 1, 23, 59)), (2, 1, datetime(2025, 1, 2)), (3, 1, datetime(2025, 1, 3))],
        "id long, id_cliente long, data_hora timestamp_ntz",
    )
    itens = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, 3)], "id_transacao long, id_produto long, quantidade int")
    produtos = spark.createDataFrame([(1, D("1.00"))], "id long, preco decimal(10,2)")
    days = [date(2025, 1, 1), date(2025, 1, 3)]
    backfill.run_day(transacoes, itens, produtos, date(2024, 1, 1), str(tmp_path))  # no rows yet
    path = backfill.run_days(transacoes, itens, produtos, days, str(tmp_path))
    assert rows(backfill.read_days(spark, path), "transaction_id") == [(1,), (3,)]
    # A rerun of one day replaces it alone; a day that lost its rows is emptied.
    backfill.run_day(transacoes, itens.where("id_transacao <> 1").unionByName(
        spark.createDataFrame([(2, 1, 9)], itens.schema)), produtos, date(2025, 1, 2), str(tmp_path))
    assert rows(backfill.read_days(spark, path), "transaction_id", "quantidade") == [(1, 1), (2, 2), (2, 9), (3, 3)]
    backfill.run_day(transacoes.where("id <> 1"), itens, produtos, date(2025, 1, 1), str(tmp_path))
    assert rows(backfill.read_days(spark, path), "transaction_id") == [(2,), (2,), (3,)]
    with pytest.raises(DataQualityError):
        backfill.run_day(transacoes, itens.withColumn("quantidade", F.lit(0)), produtos, days[1], str(tmp_path))


def test_lake(spark, rows, tmp_path):
    header = "id string, id_cliente string, data_hora string, metodo_pagamento string"
    one = spark.createDataFrame(
        [("1", "1", "2025-01-05 10:00:00", "a"), ("2", "1", "soon", "a"), ("3", "", "2025-02-01", "a")], header)
    two = spark.createDataFrame([("1", "1", "2025-03-01 10:00:00", "b")], header)
    lake.bronze_append(one, str(tmp_path), "transacoes", datetime(2025, 4, 1))
    path = lake.bronze_append(two, str(tmp_path), "transacoes", datetime(2025, 4, 2))
    lake.bronze_append(two, str(tmp_path), "transacoes", datetime(2025, 4, 2))  # retried
    refined = lake.refine(lake.read_bronze(spark, path), "transacoes")
    assert rows(refined.silver) == [(1, 1, datetime(2025, 3, 1, 10), "b")]
    assert rows(refined.quarantine, "id") == [("2",), ("3",)]


def test_compaction_keeps_rows_and_other_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 100, numPartitions=10).select(
        "id", F.to_timestamp_ntz(F.when(F.col("id") % 2 == 0, "2025-01-03").otherwise("2025-02-03")).alias("at")
    )
    lake.write_by_month(df, path, F.col("at"))
    before = tables.live(spark, path)
    lake.compact(spark, path, lake.MONTH, ["2025-01"])
    after = tables.live(spark, path)
    assert after.partitions["2025-02"] == before.partitions["2025-02"]
    assert after.partitions["2025-01"] != before.partitions["2025-01"]
    folder = tmp_path / f"t/data/version={after.version}/month=2025-01"
    assert len(list(folder.glob("*.parquet"))) == 1
    assert rows(lake.read_silver(spark, path), "id", "at") == rows(df)


def test_corrected_rows_leave_their_old_month(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, datetime(2025, 1, 5)), (2, datetime(2025, 2, 5))], "id long, at timestamp_ntz")
    moved = spark.createDataFrame([(1, datetime(2025, 3, 5)), (2, datetime(2025, 2, 5))], "id long, at timestamp_ntz")
    for df in (first, moved):
        lake.write_by_month(df, path, F.col("at"))
        assert rows(lake.read_silver(spark, path), "id", "at") == rows(df)
    assert set(tables.live(spark, path).partitions) == {"2025-02", "2025-03"}


def test_bronze_keeps_added_columns(spark, rows, tmp_path):
    lake.bronze_append(spark.createDataFrame([("1",)], "id string"), str(tmp_path), "t", datetime(2025, 1, 1))
    path = lake.bronze_append(
        spark.createDataFrame([("2", "x")], "id string, extra string"), str(tmp_path), "t", datetime(2025, 1, 2))
    assert rows(lake.read_bronze(spark, path), "id", "extra") == [("1", None), ("2", "x")]


def test_deliveries_of_one_moment_are_kept_apart(spark, rows, tmp_path):
    make = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    at, root = datetime(2025, 1, 1), str(tmp_path)
    for raw in (make("1", "3"), make("2"), make("3", "1")):  # the last is the first again
        path = lake.bronze_append(raw, root, "t", at)
    assert rows(lake.read_bronze(spark, path), "id") == [("1",), ("2",), ("3",)]
    assert {r[0] for r in lake.read_bronze(spark, path).select(F.col(lake.INGESTED).cast("timestamp_ntz")).collect()} == {at}
    # Under one id a delivery is replaced, whatever it holds.
    for raw in (make("4"), make("5", "6")):
        lake.bronze_append(raw, root, "t", at, delivery="run-7")
    assert rows(lake.read_bronze(spark, path), "id") == [(i,) for i in "12356"]
    with pytest.raises(ValueError, match="delivery id"):
        lake.bronze_append(make("7"), root, "t", at, delivery="a/b")


def test_compaction_by_measure_and_expiry(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    day = F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 90 as int))")
    df = spark.range(3000).select("id", (F.col("id") * 7919 % 1000).alias("customer"), day.alias("at"), F.lit("x").alias("x"))
    versioned = df.withColumn("version_timestamp", F.expr("timestamp_ntz'2025-05-01 00:00:00'"))
    tables.merge_into(versioned, path, at=F.col("at"))
    labelled = versioned.withColumn(tables.MONTH, F.date_format("at", "yyyy-MM"))
    held = tables.live(spark, path)
    for month in ("2025-01", "2025-02"):  # many small files in two of three months
        tables.replace_partitions(
            labelled.where(F.col(tables.MONTH) == month), path, tables.MONTH, gone=[], map_bits=held.map_bits,
            beside=lambda w, v: compaction.places.write_maps(w, "id", tables.MONTH, held.map_bits, f"{path}/places/version={v}"),
            layout=lambda d: d.repartition(6))
    sizes = {r["value"]: r["files"] for r in compaction.file_sizes(spark, path).collect()}
    assert sizes == {"2025-01": 6, "2025-02": 6, "2025-03": 1}
    open_reader = tables.read_table(spark, path)
    assert compaction.compact(spark, path, "customer", "at", target=8192) == ["2025-01", "2025-02"]
    assert sum(r["files"] for r in compaction.file_sizes(spark, path).collect()) < 13
    assert rows(tables.read_table(spark, path)) == rows(versioned) == rows(open_reader)
    # The last two commits stay readable; what only older ones name is gone.
    gone = compaction.expire(spark, path, keep=2)
    assert any(g.startswith("data/version=0/") for g in gone) and any(g.startswith("places/") for g in gone)
    assert rows(open_reader) == rows(versioned) == rows(tables.read_table(spark, path))
    compaction.expire(spark, path, keep=1)
    assert rows(tables.read_table(spark, path)) == rows(versioned)
    live = tables.live(spark, path)
    folders = {f"version={v}/{tables.MONTH}={m}" for m, v in live.partitions.items()}
    assert {str(p.relative_to(tmp_path / "t/data")) for p in (tmp_path / "t/data").glob("version=*/*=*")} == folders
    # Merges still find where keys are.
    moved = versioned.where("id = 0").withColumn("at", F.expr("timestamp_ntz'2025-03-31 00:00:00'"))
    tables.merge_into(moved, path, at=F.col("at"))
    assert tables.read_table(spark, path).count() == 3000


def test_files_cover_small_ranges_of_both_columns(spark, tmp_path):
    df = spark.range(20000).select("id", (F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 977).alias("b"), F.lit("m").alias("m"))
    path = str(tmp_path / "t")
    tables.replace_partitions(df, path, "m", layout=lambda d: d.repartition(16))
    compaction.compact(spark, path, "a", "b", target=8192, values=["m"])
    spans = tables.read_partitions(spark, path).groupBy("_metadata.file_path").agg(
        F.max("a") - F.min("a"), F.max("b") - F.min("b")).collect()
    assert len(spans) >= 8 and sum(r[1] * r[2] for r in spans) / len(spans) < 0.5 * 1000 * 977


def test_rows_that_a_compaction_task_sorts_are_bounded(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "MOST_ROWS", 1000)
    df = spark.range(8000).select("id", (F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 977).alias("b"), F.lit("m").alias("m"))
    path = str(tmp_path / "t")
    tables.replace_partitions(df, path, "m", layout=lambda d: d.repartition(16))
    compaction.compact(spark, path, "a", "b")
    found = tables.read_partitions(spark, path)
    sizes = [r["count"] for r in found.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000
    assert rows(found.select("id", "a", "b")) == rows(df.select("id", "a", "b"))


def test_nothing_to_compact(spark, tmp_path):
    assert compaction.compact(spark, str(tmp_path / "none"), "a", "b") == [] == compaction.expire(spark, str(tmp_path / "none"))
