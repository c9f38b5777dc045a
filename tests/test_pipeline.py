import pytest
from pyspark.sql import functions as F

from feira.__main__ import main, stored_tables
from feira.plans import pipeline, warehouse
from feira.plans.incremental import load_checkpoint
from feira.plans.tables import read_table
from feira.sources.selection import MissingSourceError


def test_all_jobs_in_order(spark, tmp_path, capsys):
    raw, root, wh = (str(tmp_path / d) for d in ("raw", "db", "wh"))
    main(["generate", "--raw", raw, "--customers", "20", "--products", "10", "--transactions", "80"])
    main(["validate", "--raw", raw, "--out", str(tmp_path / "violations")])
    assert spark.read.parquet(str(tmp_path / "violations")).isEmpty()
    main(["load", "--raw", raw, "--root", root])
    main(["quality", "--root", root, "--report", str(tmp_path / "report")])
    main(["warehouse", "--raw", raw, "--warehouse", wh])
    main(["incremental", "--root", root, "--warehouse", wh])
    main(["reports", "--root", root, "--out", str(tmp_path / "reports")])
    assert len(list((tmp_path / "reports").iterdir())) == 4
    assert "aov_by_district" in capsys.readouterr().out
    by_district = spark.read.option("header", True).csv(str(tmp_path / "reports/aov_by_district"))
    assert "valor_medio_encomenda" in by_district.columns and not by_district.isEmpty()

    stored = stored_tables(spark, root)
    assert {t: df.count() for t, df in stored.items()} == {
        "clientes": 20, "produtos": 10, "transacoes": 80, "transacao_itens": 80,
    }
    assert read_table(spark, f"{wh}/fact_transactions_incremental").count() == 80
    assert load_checkpoint(spark, f"{wh}/checkpoints/transacoes") == stored["transacoes"].agg(F.max("data_hora")).first()[0]

    # Every item is sold at the catalog price, so all totals agree.
    pipeline.register_reports(stored)
    trend = spark.sql("SELECT sum(receita) FROM monthly_revenue_trend").first()[0]
    value = warehouse.read_warehouse(spark, wh, "dim_customer_value").agg(F.sum("customer_lifetime_value")).first()[0]
    assert trend == value


def test_source_by_environment(spark, tmp_path):
    opened = []

    def source(name):
        def read():
            opened.append(name)
            return {}
        return read

    def unreachable():
        raise OSError("no such bucket")

    for environment, name in (("dev", "csv"), ("prod", "database")):
        opened.clear()
        with pytest.raises(MissingSourceError):
            pipeline.run_pipeline(environment, str(tmp_path), source("csv"), source("database"), unreachable)
        assert opened == [name]
