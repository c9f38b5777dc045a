"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame.

Where an operator needs dirty, older or newer data, it is derived from whole tables by
their attributes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira import entities as E
from feira.functions import calendar
from feira.operators import (
    analytics, anonymity, clicks, constraints, copurchase, expectations, fact, features, history, increment, merge,
    metrics, pii, row_rules, scd2,
)
from feira.plans import (
    backfill, compaction, dimension, incremental, lake, loader, quality_gate, tables, warehouse,
)
from feira.schemas import AMOUNT, PRICE, RAW_HEADERS, TOTAL, conform
from feira.session import scratch_path
from feira.sources import files, landing
from feira.streaming import clicks as click_stream
from feira.streaming import incremental as change_stream
from feira.streaming import late as late_clicks
from feira.streaming import versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


JOBS: set[str] = set()  # queries that write and read back tables


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def job(f: Query) -> Query:
    JOBS.add(f.__name__)
    return query(f)


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- business reports -------------------------------------------------------------


@query
def top_customers(spark, sf):
    return analytics.top_customers(
        E.clientes(spark, sf), E.transacoes(spark, sf), E.itens(spark, sf), E.CHARGED
    )


@query
def top_customers_unit_price(spark, sf):
    """By quantity times unit price, the reports' own price path; here units cost what the
    product does."""
    prices = E.produtos(spark, sf).select(F.col("id").alias("id_produto"), F.col("preco").alias("preco_unitario"))
    lines = E.itens(spark, sf).select("id_transacao", "id_produto", "quantidade").join(prices, "id_produto")
    return analytics.top_customers(E.clientes(spark, sf), E.transacoes(spark, sf), lines)


@query
def best_sellers_by_category(spark, sf):
    return analytics.best_sellers(E.produtos(spark, sf), E.itens(spark, sf))


@query
def monthly_revenue_trend(spark, sf):
    return analytics.monthly_trend(E.transacoes(spark, sf), E.itens(spark, sf), E.CHARGED)


@query
def aov_by_district(spark, sf):
    return analytics.aov_by_district(
        E.clientes(spark, sf), E.transacoes(spark, sf), E.itens(spark, sf), E.CHARGED
    )


# --- fact and warehouse aggregates -------------------------------------------------


def _order_fact(spark, sf):
    return fact.order_fact(E.transacoes(spark, sf), E.itens(spark, sf), E.produtos(spark, sf))


@query
def transaction_fact(spark, sf):
    return fact.transaction_fact(E.transacoes(spark, sf), E.itens(spark, sf), E.produtos(spark, sf))


@query
def transaction_fact_charged(spark, sf):
    """The fact by what lines were charged; here that is the product's price."""
    prices = E.produtos(spark, sf).select(F.col("id").alias("id_produto"), F.col("preco").alias("preco_unitario"))
    lines = E.itens(spark, sf).select("id_transacao", "id_produto", "quantidade").join(prices, "id_produto")
    return fact.transaction_fact(E.transacoes(spark, sf), lines, None, price_basis="charged")


@query
def customer_lifetime_value(spark, sf):
    return metrics.customer_lifetime_value(_order_fact(spark, sf))


@query
def daily_revenue(spark, sf):
    return metrics.revenue_over_time(_order_fact(spark, sf)).daily


@query
def monthly_revenue_undated(spark, sf):
    """Revenue by month where orders in the works have no date yet."""
    dated = F.when(F.col("estado") != "P", F.col("data_hora"))
    orders = E.transacoes(spark, sf).withColumn("data_hora", dated)
    undated = fact.order_fact(orders, E.itens(spark, sf), E.produtos(spark, sf))
    return metrics.revenue_over_time(undated, keep_undated=True).monthly


@query
def weekly_revenue(spark, sf):
    return metrics.revenue_over_time(_order_fact(spark, sf)).weekly


@query
def weekly_revenue_by_iso_year(spark, sf):
    return metrics.revenue_over_time(_order_fact(spark, sf)).weekly_iso


@query
def monthly_revenue(spark, sf):
    return metrics.revenue_over_time(_order_fact(spark, sf)).monthly


def _basket_lines(spark, sf):
    return E.itens(spark, sf).select(
        F.col("id_transacao").alias("transaction_id"), F.col("id_produto").alias("product_id")
    )


@query
def co_purchase(spark, sf):
    return copurchase.co_purchases(_basket_lines(spark, sf))


@query
def product_recommendations(spark, sf):
    return copurchase.recommendations(_basket_lines(spark, sf))


@query
def calendar_columns(spark, sf):
    at = F.col("data_hora")
    return E.transacoes(spark, sf).select(
        "id",
        F.to_date(at).alias("date"),
        calendar.iso_week(at).alias("week"),
        calendar.iso_year(at).alias("iso_year"),
        calendar.month_label(at).alias("month"),
        calendar.month_start(at).alias("month_start"),
        (at - F.expr("interval 2 days")).alias("late_bound"),
        landing.partition_path_column(at).alias("landing_path"),
    )


# --- data quality ------------------------------------------------------------------


def _dirty_clientes(spark, sf):
    """Text customers: some e-mails without '@', some missing, some dates malformed."""
    email = (
        F.when(F.col("saldo") < 0, F.replace("email", F.lit("@"), F.lit(" at ")))
        .when(F.col("segmento") != "MACHINERY", F.col("email"))
    )
    registered = (
        F.when(F.col("distrito") == "PERU", "26/10/2025")
        .when(F.col("distrito") == "CHINA", "2025-02-30")
        .when(F.col("distrito") == "JAPAN", "")
        .when(F.col("distrito") == "INDIA", "2025-1-5 7:05:09")
        .otherwise("2025-1-5")
    )
    return E.clientes(spark, sf).select(
        F.col("id").cast("string").alias("id"), "nome", email.alias("email"),
        registered.alias("data_registo"), "distrito",
    )


def _dirty_produtos(spark, sf):
    price = (
        F.when(F.col("tamanho") == 1, "")
        .when(F.col("tamanho") == 2, "n/a")
        .when(F.col("tamanho") == 3, "-1.50")
        .when(F.col("tamanho") == 4, "nan")
        .when(F.col("tamanho") == 5, "0")
        .when(F.col("tamanho") == 6, " 7.5 ")
        .otherwise(F.col("preco").cast("string"))
    )
    return E.produtos(spark, sf).select(
        F.col("id").cast("string").alias("id"), "nome", "categoria", price.alias("preco"), "fornecedor"
    )


def _dirty_transacoes(spark, sf):
    text = F.date_format("data_hora", "yyyy-MM-dd HH:mm:ss")
    low = F.col("metodo_pagamento") == "5-LOW"
    at = (
        F.when(low & (F.col("estado") == "P"), "yesterday")
        .when(low & (F.col("estado") == "F"), F.date_format("data_hora", "yyyy-MM-dd"))
        .when(low, "")
        .otherwise(text)
    )
    return E.transacoes(spark, sf).select(
        F.col("id").cast("string").alias("id"), F.col("id_cliente").cast("string").alias("id_cliente"),
        at.alias("data_hora"), "metodo_pagamento",
    )


def _dirty_itens(spark, sf):
    """Order lines as text; the key is the order and line number, which does repeat."""
    lines = E.table(spark, sf, "lineitem")
    quantity = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 3), "3.0")
        .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 4), "0")
        .when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 5), " 5 ")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    unit = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") == 3), "-0.01")
        .when((F.col("l_returnflag") == "A") & (F.col("l_quantity") == 4), "free")
        .otherwise(F.col("l_extendedprice").cast(AMOUNT).cast("string"))
    )
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        F.col("l_orderkey").cast("string").alias("id_transacao"),
        F.col("l_partkey").cast("string").alias("id_produto"),
        quantity.alias("quantidade"), unit.alias("preco_unitario"),
    )


def _dirty(spark, sf):
    return {
        "clientes": _dirty_clientes(spark, sf),
        "produtos": _dirty_produtos(spark, sf),
        "transacoes": _dirty_transacoes(spark, sf),
        "transacao_itens": _dirty_itens(spark, sf),
    }


def _expectation_results(spark, sf):
    typed = {name: conform(df, name) for name, df in _dirty(spark, sf).items()}
    return expectations.check_tables(typed)


@query
def expectation_results(spark, sf):
    return _expectation_results(spark, sf)


@query
def expectation_issue_count(spark, sf):
    return expectations.total_issues(_expectation_results(spark, sf))


@query
def row_violations(spark, sf):
    return row_rules.all_violations(_dirty(spark, sf))


PIECE_ROWS = 1_000_000  # lines that a task sorts and writes, about


def _write_dirty_files(spark, sf, folder):
    """The dirty tables as headed CSV, one file for each length of id, rows by id; some lines
    have a field too many or too few. A file is a folder of pieces, which many tasks write; the
    first piece is headed."""
    odd = {
        "clientes": (F.col("distrito") == "NATION_3", F.col("distrito") == "NATION_4"),
        "produtos": (F.col("fornecedor") == "Brand#3", F.col("fornecedor") == "Brand#4"),
        "transacoes": [
            (F.col("metodo_pagamento") == p) & F.startswith("data_hora", F.lit("1996-01")) for p in ("1-URGENT", "2-HIGH")
        ],
        "transacao_itens": (F.col("quantidade") == "7", F.col("quantidade") == "8"),
    }
    for name, df in _dirty(spark, sf).items():
        if name == "transacoes":
            df = df.withColumns({"id_produto": F.lit("1"), "quantidade": F.lit("1")})
        header = RAW_HEADERS[name]
        wide, narrow = odd[name]
        fields = [F.coalesce(c, F.lit("")) for c in header]
        line = (
            F.when(F.coalesce(wide, F.lit(False)), F.concat_ws(",", *fields, F.lit("extra")))
            .when(F.coalesce(narrow, F.lit(False)), F.concat_ws(",", *fields[:-1]))
            .otherwise(F.concat_ws(",", *fields))
        )
        rows = df.select(F.length("id").alias("part"), F.col("id").cast("bigint").alias("nth"), line.alias("value"))
        heads = rows.select("part").distinct().select("part", F.lit(-1).cast("bigint").alias("nth"), F.lit(",".join(header)).alias("value"))
        by = ("part", "nth", "value")
        ranges = math.ceil(max(df.count(), 1) / PIECE_ROWS)
        rows.unionByName(heads).repartitionByRange(ranges, *by).sortWithinPartitions(*by).select(
            "part", "value"
        ).write.partitionBy("part").text(f"{folder}/{name}.csv")


@job
def row_violation_lines(spark, sf):
    """The violations of raw files of all four entities, by file and row number."""
    folder = scratch_path(spark, "raw")
    _write_dirty_files(spark, sf, folder)
    status = quality_gate.validate_folder(spark, folder, f"{folder}/violations", pieces=True)
    if set(status.values()) != {"finished"}:
        raise RuntimeError(str(status))
    return spark.read.parquet(f"{folder}/violations").withColumn(
        "ficheiro", F.regexp_extract("ficheiro", "([a-z_]+[.]csv/part=[0-9]+)/", 1)
    )


@query
def broken_constraints(spark, sf):
    lines = E.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("id_transacao"), F.col("l_partkey").alias("id_produto"),
    )
    # Customers in debt and out-of-range products count as deleted.
    return constraints.broken_constraints({
        "clientes": E.clientes(spark, sf).where("saldo >= 0"),
        "produtos": E.produtos(spark, sf).where("tamanho < 50"),
        "transacoes": E.transacoes(spark, sf),
        "transacao_itens": lines,
    })


@query
def constraint_breaches(spark, sf):
    """All constraints over the dirty tables, typed; some customers and products are gone."""
    typed = {name: conform(df, name) for name, df in _dirty(spark, sf).items()}
    typed["clientes"] = typed["clientes"].where("distrito <> 'NATION_3'")
    typed["produtos"] = typed["produtos"].where("fornecedor <> 'Brand#5'")
    return constraints.breaches(typed)


# --- incremental maintenance -------------------------------------------------------

OLD, NEW = "2002-01-01 00:00:00", "2002-02-01 00:00:00"


def _closed_orders(spark, sf):
    return E.transacoes(spark, sf).where(F.col("estado") != "O")


@query
def upsert_orders(spark, sf):
    """Closed orders, upserted with totals recomputed from the lines of all orders."""
    target = E.table(spark, sf, "orders").where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("id_cliente"),
        F.col("o_totalprice").cast(TOTAL).alias("valor"), _at(OLD).alias("version_timestamp"),
    )
    batch = fact.order_revenue(E.transacoes(spark, sf), E.itens(spark, sf), E.CHARGED).select(
        F.col("id_transacao").alias("id"), "id_cliente", F.col("receita").cast(TOTAL).alias("valor")
    )
    return merge.upsert(target, batch, stamp=_at(NEW))


def _shipments(spark, sf):
    """Each shipped line as a new version of its order."""
    return E.itens(spark, sf).join(
        E.transacoes(spark, sf).withColumnRenamed("id", "id_transacao"), "id_transacao"
    ).select(
        F.col("id_transacao").alias("id"), "id_cliente", "data_hora",
        F.col("devolucao").alias("metodo_pagamento"), F.col("data_envio").alias("version_timestamp"),
    )


@query
def latest_version(spark, sf):
    return merge.latest_version(E.itens(spark, sf).select(
        F.col("id_transacao").alias("id"), "id_produto", "quantidade",
        F.col("data_envio").alias("version_timestamp"),
    ))


def _versioned(orders, stamp):
    return orders.select(
        "id", "id_cliente", "data_hora", "metodo_pagamento", stamp.alias("version_timestamp")
    )


@query
def merge_shipments(spark, sf):
    target = _versioned(_closed_orders(spark, sf), F.col("data_hora"))
    return merge.merge_increment(target, _shipments(spark, sf))


@query
def merge_shipments_newer_only(spark, sf):
    target = _versioned(_closed_orders(spark, sf), F.col("data_hora") + F.expr("interval 60 days"))
    return merge.merge_increment(target, _shipments(spark, sf), newer_only=True)


CHECKPOINT = datetime(2000, 6, 1)


def _increment(spark, sf):
    return increment.increment_since(
        _versioned(E.transacoes(spark, sf), F.col("data_hora")), CHECKPOINT
    )


@query
def increment_since(spark, sf):
    return _increment(spark, sf)


@query
def next_checkpoint(spark, sf):
    return increment.next_checkpoint(_increment(spark, sf), CHECKPOINT)


@job
def incremental_fact(spark, sf):
    """Two checkpointed runs: the state at 2000-06-01, then the whole source."""
    root = scratch_path(spark, "incremental")
    source = _versioned(E.transacoes(spark, sf), F.col("data_hora"))
    early = source.where(F.col("data_hora") < _at("2000-06-01"))
    for state in (early, source):
        incremental.run_incremental(state, f"{root}/fact", f"{root}/state")
    return tables.read_table(spark, f"{root}/fact").select(*source.columns)


def _dim_and_snapshot(spark, sf):
    """A dimension without one supplier, and a snapshot with that supplier, new prices,
    renamed products, and some products gone."""
    parts = E.produtos(spark, sf)
    dim = scd2.initial_dimension(parts.where("fornecedor <> 'Brand#5'"), _at("2025-01-01"))
    price = F.when(F.col("tamanho") >= 40, F.col("preco") * F.lit(2)).otherwise(F.col("preco"))
    name = F.when(F.col("fornecedor") == "Brand#7", F.concat("nome", F.lit(" plus"))).otherwise(F.col("nome"))
    snapshot = parts.where("not (categoria = 'PROMO' and tamanho < 5)").select(
        "id", name.alias("nome"), "categoria", "fornecedor", price.cast(PRICE).alias("preco")
    )
    return dim, snapshot


def _plain_times(dim):
    return dim.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start_date", "end_date")}
    )


@query
def scd2_products(spark, sf):
    return _plain_times(scd2.apply_scd2(*_dim_and_snapshot(spark, sf), _at("2025-02-01")))


@query
def scd2_products_strict(spark, sf):
    return _plain_times(
        scd2.apply_scd2(*_dim_and_snapshot(spark, sf), _at("2025-02-01"), strict=True)
    )


@job
def scd2_stored_history(spark, sf):
    """The stored dimension after three runs: first load, changes, and the same snapshot again."""
    path = scratch_path(spark, "dimension")
    dim, snapshot = _dim_and_snapshot(spark, sf)
    dimension.update_dimension(dim, path, datetime(2025, 1, 1))
    dimension.update_dimension(snapshot, path, datetime(2025, 2, 1))
    dimension.update_dimension(snapshot, path, datetime(2025, 3, 1))
    return _plain_times(dimension.read_dimension(spark, path))


def _product_snapshots(spark, sf):
    """Four snapshots: one without a supplier; with that, new prices and names, and some gone;
    the old names back; and all as at first, some dearer."""
    first, second = _dim_and_snapshot(spark, sf)
    columns = ["id", "nome", "categoria", "fornecedor", "preco"]
    parts = E.produtos(spark, sf)
    third = second.drop("nome").join(parts.select("id", "nome"), "id")
    dearer = F.when(F.col("tamanho") < 20, F.col("preco") + 1).otherwise(F.col("preco")).cast(PRICE)
    fourth = parts.withColumn("preco", dearer)
    return {day: df.select(*columns) for day, df in zip((1, 8, 15, 22), (first, second, third, fourth))}


def _land_products(spark, sf, root):
    """The snapshots land by day, the second of them last."""
    others = {n: spark.createDataFrame([], "id string") for n in ("clientes", "transacoes")}
    snapshots = _product_snapshots(spark, sf)
    for day in sorted(snapshots, key=lambda d: (d == 8, d)):
        landing.land({"produtos": snapshots[day], **others}, root, date(2025, 1, day), landing.version_tag(datetime(2025, 1, day)))


def _history_from_deliveries(spark, sf, strict):
    root = scratch_path(spark, "landing")
    _land_products(spark, sf, root)
    landed = landing.landed_versions(spark, root, "produtos", ["id", "nome", "categoria", "fornecedor", "preco"])
    typed = landed.withColumns({"id": F.col("id").cast("bigint"), "preco": F.col("preco").cast(PRICE)})
    return _plain_times(history.history(typed, "landed_at", strict))


@job
def scd2_from_deliveries(spark, sf):
    """The dimension from all landed versions of the products at once, one of which came late."""
    return _history_from_deliveries(spark, sf, False)


@job
def scd2_from_deliveries_strict(spark, sf):
    return _history_from_deliveries(spark, sf, True)


# --- files, tables and jobs --------------------------------------------------------


@job
def csv_round_trip(spark, sf):
    """Orders written as raw CSV with the extra columns a raw file carries, and read back."""
    path = scratch_path(spark, "csv")
    raw = E.transacoes(spark, sf).select(
        "id", "id_cliente", F.lit(None).cast("long").alias("id_produto"),
        F.lit(1).alias("quantidade"), "data_hora", "metodo_pagamento",
    )
    files.write_csv(files.raw_text(raw, "transacoes"), path)
    return files.read_entity_csv(spark, path, "transacoes")


def _union_as_text(frames):
    """(tabela, c1, c2, ...): the columns of all frames in order, as text."""
    most = max(len(df.columns) for df in frames.values())
    rows = None
    for name, df in frames.items():
        cells = [F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(df.columns, 1)]
        cells += [F.lit(None).cast("string").alias(f"c{i}") for i in range(len(cells) + 1, most + 1)]
        one = df.select(F.lit(name).alias("tabela"), *cells)
        rows = one if rows is None else rows.unionByName(one)
    return rows


@job
def csv_all_entities(spark, sf):
    """All four entities as raw files, columns in another order than their table's, read back
    typed."""
    folder = scratch_path(spark, "csv")
    for name, df in _dirty(spark, sf).items():
        files.write_csv(df.select(*reversed(df.columns)), f"{folder}/{name}.csv")
    return _union_as_text(files.read_csv_folder(spark, folder))


@job
def landed_day(spark, sf):
    """All entities of a day as its newest version has them; that one names the columns in
    another order."""
    root, day = scratch_path(spark, "landing"), date(2025, 10, 26)
    first = {
        "clientes": E.clientes(spark, sf).select("id", "nome", "distrito"),
        "produtos": E.produtos(spark, sf).select("id", "nome", "categoria", "preco"),
        "transacoes": E.transacoes(spark, sf).select("id", "id_cliente", "metodo_pagamento"),
    }
    second = {name: df.select(*reversed(df.columns)) for name, df in first.items()}
    second["clientes"] = second["clientes"].withColumn("distrito", F.initcap("distrito"))
    for hour, delivery in ((9, first), (15, second)):
        landing.land(delivery, root, day, landing.version_tag(datetime(2025, 10, 26, hour)))
    headers = {name: df.columns for name, df in first.items()}
    return _union_as_text(landing.read_landed_day(spark, root, day, headers))


def _landed_customers(spark, sf, pick):
    root = scratch_path(spark, "landing")
    day = date(2025, 10, 26)
    first = {
        "clientes": E.clientes(spark, sf).select("id", "nome", "distrito"),
        "produtos": E.produtos(spark, sf).select("id", "nome"),
        "transacoes": E.transacoes(spark, sf).select("id", "id_cliente"),
    }
    second = {**first, "clientes": first["clientes"].withColumn("distrito", F.initcap("distrito"))}
    for hour, delivery in ((9, first), (15, second)):
        landing.land(delivery, root, day, landing.version_tag(datetime(2025, 10, 26, hour)))
    return landing.read_landed(spark, root, day, "clientes", first["clientes"].columns, pick).select(
        F.col("id").cast("bigint").alias("id"), "nome", "distrito"
    )


@job
def landing_newest_version(spark, sf):
    return _landed_customers(spark, sf, "last")


@job
def landing_oldest_version(spark, sf):
    return _landed_customers(spark, sf, "first")


@job
def load_audit(spark, sf):
    """A load in which the order lines fail, as their ids repeat, and the rest succeed."""
    root = scratch_path(spark, "load")
    sources = {
        "clientes": lambda: E.clientes(spark, sf).withColumn("data_registo", F.lit("2025-01-05")),
        "produtos": lambda: E.produtos(spark, sf),
        "transacao_itens": lambda: _dirty_itens(spark, sf),
        "transacoes": lambda: E.transacoes(spark, sf),
    }
    try:
        loader.load_all(spark, sources, root)
    except loader.LoadError:
        pass
    return loader.read_audit(spark, root).select("tabela", "ficheiro", "linhas_carregadas", "sucesso")


@job
def loaded_lines(spark, sf):
    """Order lines summed per order and part, under a key of both, loaded into their table."""
    root = scratch_path(spark, "load")
    parts = E.table(spark, sf, "part").count()
    lines = E.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("quantidade"),
        F.max(F.col("l_extendedprice").cast(PRICE)).alias("preco_unitario"),
    )
    batch = lines.select(
        (F.col("l_orderkey") * F.lit(parts + 1) + F.col("l_partkey")).alias("id"),
        F.col("l_orderkey").alias("id_transacao"), F.col("l_partkey").alias("id_produto"),
        "quantidade", "preco_unitario",
    )
    loader.load_table(conform(batch, "transacao_itens"), "transacao_itens", root, datetime(2025, 1, 1), buckets=8)
    return tables.read_table(spark, f"{root}/transacao_itens").drop("version_timestamp")


@job
def load_rejects(spark, sf):
    """Each kind of bad table fails as a whole, and the audit says why."""
    root = scratch_path(spark, "load")
    customers = E.clientes(spark, sf).withColumn("data_registo", F.lit("2025-01-05"))
    sources = {
        "clientes": lambda: customers.withColumn("email", F.lit("same@example.com")),
        "produtos": lambda: _dirty_produtos(spark, sf),
        "transacoes": lambda: _dirty_transacoes(spark, sf),
        "transacao_itens": lambda: _dirty_itens(spark, sf),
    }
    try:
        loader.load_all(spark, sources, root)
    except loader.LoadError:
        pass
    reason = F.regexp_extract_all("erro", F.lit(r"(?:: |; )([a-z_]+): "), 1)
    return loader.read_audit(spark, root).select(
        "tabela", "linhas_carregadas", "sucesso", F.array_join(F.array_sort(reason), ",").alias("colunas")
    )


@job
def loaded_products(spark, sf):
    """Products loaded twice, the second time with the prices of large ones doubled."""
    root = scratch_path(spark, "load")
    parts = conform(E.produtos(spark, sf), "produtos")
    large = E.produtos(spark, sf).where("tamanho >= 40")
    dearer = conform(large.withColumn("preco", F.col("preco") * 2), "produtos")
    for batch, day in ((parts, 1), (dearer, 2)):
        loader.load_table(batch, "produtos", root, datetime(2025, 1, day))
    return tables.read_table(spark, f"{root}/produtos").withColumn(
        "version_timestamp", F.col("version_timestamp").cast("timestamp_ntz")
    )


@job
def warehouse_totals(spark, sf):
    """Rows and total of each table of a freshly built warehouse."""
    root = scratch_path(spark, "warehouse")
    warehouse.build_warehouse(
        E.transacoes(spark, sf), E.itens(spark, sf), E.produtos(spark, sf), root, datetime(2025, 1, 1)
    )
    measure = {
        "dim_products": "preco",
        "dim_customer_value": "customer_lifetime_value",
        "fact_recommendations": "co_purchase_count",
        "fact_daily_sales": "daily_revenue",
        "fact_weekly_sales": "weekly_revenue",
        "fact_monthly_sales": "monthly_revenue",
    }
    parts = [
        warehouse.read_warehouse(spark, root, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.sum(column).cast(TOTAL).alias("total"),
        )
        for name, column in measure.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@job
def warehouse_run_metrics(spark, sf):
    """Rows and missing values of every column, as measured by the writes of two builds."""
    root = scratch_path(spark, "warehouse")
    products = E.produtos(spark, sf)
    dearer = products.withColumn("preco", F.when(F.col("tamanho") >= 40, F.col("preco") * 2).otherwise(F.col("preco")).cast(PRICE))
    for day, parts in ((1, products), (2, dearer)):
        warehouse.build_warehouse(E.transacoes(spark, sf), E.itens(spark, sf), parts, root, datetime(2025, 1, day))
    measured = warehouse.run_metrics(spark, root)
    return measured.select(
        "run", "table_name", "n_rows", F.explode("nulls").alias("column_name", "n_nulls")
    )


@job
def backfilled_days(spark, sf):
    """The fact of January 1998, rebuilt day by day in one run, and again."""
    root = scratch_path(spark, "backfill")
    days = [date(1998, 1, 1) + timedelta(days=i) for i in range(31)]
    args = E.transacoes(spark, sf), E.itens(spark, sf), E.produtos(spark, sf)
    path = backfill.run_days(*args, days, root)
    backfill.run_day(*args, days[0], root)
    return backfill.read_days(spark, path).select(*fact.FACT_COLUMNS)


def _refined(spark, sf):
    root = scratch_path(spark, "lake")
    raw = _dirty_transacoes(spark, sf)
    fixes = E.transacoes(spark, sf).where("estado = 'P'").select(
        F.col("id").cast("string").alias("id"), F.col("id_cliente").cast("string").alias("id_cliente"),
        F.date_format("data_hora", "yyyy-MM-dd HH:mm:ss").alias("data_hora"),
        F.lit("corrected").alias("metodo_pagamento"),
    )
    lake.bronze_append(raw, root, "transacoes", datetime(2025, 1, 1))
    path = lake.bronze_append(fixes, root, "transacoes", datetime(2025, 1, 2))
    return root, lake.refine(lake.read_bronze(spark, path), "transacoes")


@job
def lake_silver_months(spark, sf):
    """Silver orders by month partition after two deliveries and a compaction."""
    root, refined = _refined(spark, sf)
    path = f"{root}/silver/transacoes"
    lake.write_by_month(refined.silver, path, F.col("data_hora"))
    lake.compact(spark, path, lake.MONTH, ["1998-01", "1998-02"])
    return lake.read_silver(spark, path).groupBy(F.col(lake.MONTH).cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("metodo_pagamento") == "corrected").alias("n_corrected"),
        F.min("id").alias("lowest_id"), F.max("data_hora").alias("latest"),
    )


def _corrected_silver(spark, sf):
    """Silver orders, written, then rebuilt after a delivery that moves orders to another month."""
    root = scratch_path(spark, "lake")
    moved = E.transacoes(spark, sf).where("estado = 'P'").select(
        F.col("id").cast("string").alias("id"), F.col("id_cliente").cast("string").alias("id_cliente"),
        F.lit("2010-05-05 05:05:05").alias("data_hora"), F.lit("corrected").alias("metodo_pagamento"),
    )
    silver = f"{root}/silver/transacoes"
    for day, raw in ((1, _dirty_transacoes(spark, sf)), (2, moved)):
        path = lake.bronze_append(raw, root, "transacoes", datetime(2025, 1, day))
        refined = lake.refine(lake.read_bronze(spark, path), "transacoes")
        lake.write_by_month(refined.silver, silver, F.col("data_hora"))
    return lake.read_silver(spark, silver).withColumn(lake.MONTH, F.col(lake.MONTH).cast("string"))


@job
def lake_silver_rows(spark, sf):
    return _corrected_silver(spark, sf)


@job
def lake_gold_revenue(spark, sf):
    """The gold step: monthly revenue over silver orders."""
    return analytics.monthly_trend(_corrected_silver(spark, sf), E.itens(spark, sf), E.CHARGED)


@job
def compacted_orders(spark, sf):
    """Orders by month in many small files, corrected, compacted along customer and time, and
    rid of old versions."""
    path = f"{scratch_path(spark, 'compaction')}/orders"
    orders = E.transacoes(spark, sf).select("id", "id_cliente", "data_hora", "metodo_pagamento")
    by_month = orders.withColumn(tables.MONTH, calendar.month_label(F.col("data_hora")))
    many = max(8, -(-orders.count() // compaction.MOST_ROWS))
    tables.replace_partitions(by_month, path, tables.MONTH, layout=lambda df: df.repartition(many))
    fixed = by_month.where("year(data_hora) = 1996").withColumn("metodo_pagamento", F.lit("corrected"))
    tables.replace_partitions(fixed, path, tables.MONTH, gone=[], layout=lambda df: df.repartition(many))
    before = compaction.file_sizes(spark, path).agg(F.sum("files")).first()[0]
    compacted = compaction.compact(spark, path, "id_cliente", "data_hora")
    after = compaction.file_sizes(spark, path).agg(F.sum("files")).first()[0]
    compaction.expire(spark, path, keep=1)
    if compacted and after >= before:
        raise RuntimeError(f"{after} files of {before}")
    return tables.read_table(spark, path)


@job
def lake_quarantine(spark, sf):
    _, refined = _refined(spark, sf)
    return refined.quarantine.select("id", "id_cliente", "data_hora", "metodo_pagamento")


# --- clicks ------------------------------------------------------------------------


@query
def clicks_tumbling(spark, sf):
    return clicks.tumbling(E.table(spark, sf, "events"))


@query
def clicks_sliding(spark, sf):
    return clicks.sliding(E.table(spark, sf, "events"))


@query
def clicks_sliding_uneven(spark, sf):
    return clicks.sliding(E.table(spark, sf, "events"), "60 minutes", "25 minutes")


@query
def clicks_sessions(spark, sf):
    return clicks.sessions(E.table(spark, sf, "events"))


def _streamed(spark, sf, windows):
    root = scratch_path(spark, "clicks")
    # A pattern, as the stream reader takes folders or patterns but not a single file.
    events = click_stream.read_clicks(spark, f"{sf}/event[s].parquet")
    result = windows(events)
    click_stream.run_available(result, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(result.schema).parquet(f"{root}/out")


@job
def stream_tumbling(spark, sf):
    return _streamed(spark, sf, click_stream.tumbling)


@job
def stream_sliding(spark, sf):
    return _streamed(spark, sf, click_stream.sliding)


@job
def stream_sessions(spark, sf):
    return _streamed(spark, sf, click_stream.sessions)


@job
def stream_merged_orders(spark, sf):
    """Two deliveries of order versions, streamed one by one into the fact."""
    root = scratch_path(spark, "changes")
    orders = E.transacoes(spark, sf)
    changed = orders.where("estado = 'P'").withColumn("metodo_pagamento", F.lit("corrected"))
    _versioned(orders, _at(OLD)).write.parquet(f"{root}/in/delivery=1")
    _versioned(changed, _at(NEW)).write.parquet(f"{root}/in/delivery=2")
    schema = _versioned(orders, _at(OLD)).schema
    for n in (1, 2, 2):
        source = change_stream.read_changes(spark, f"{root}/in/delivery=[1-{n}]", schema)
        change_stream.merge_available(source, f"{root}/fact", f"{root}/checkpoint", at="data_hora", newer_only=True)
    return tables.read_table(spark, f"{root}/fact").select(*schema.names)


@job
def stream_latest_versions(spark, sf):
    """The newest version of each order, from deliveries in which returned lines come a day
    late, so that files overlap; the stream is started once for each."""
    root = scratch_path(spark, "versions")
    lines = E.itens(spark, sf).select(
        F.col("id_transacao").alias("id"), "id_produto", "quantidade",
        F.col("data_envio").alias("version_timestamp"), "devolucao",
    )
    arrives = F.col("version_timestamp") + F.expr("interval 1 day") * F.when(F.col("devolucao") == "R", 1).otherwise(0)
    late = lines.withColumn("delivery", F.when(arrives < _at("1995-01-01"), 1).when(arrives < _at("1997-01-01"), 2).otherwise(3))
    late.drop("devolucao").write.partitionBy("delivery").parquet(f"{root}/in")
    schema = lines.drop("devolucao").schema
    for n in (1, 2, 3, 3):
        changes = change_stream.read_changes(spark, f"{root}/in/delivery=[1-{n}]", schema)
        versions.follow_available(changes, f"{root}/out", f"{root}/checkpoint")
    return versions.read_newest(spark, f"{root}/out")


def _late_clicks(spark, sf):
    """Clicks in two deliveries, then small purchases that were held back since before 2024-01-20."""
    root = scratch_path(spark, "late")
    events = E.table(spark, sf, "events")
    held = (F.col("event_type") == "purchase") & (F.col("value") < 30) & (F.col("ts") < _at("2024-01-20"))
    delivery = F.when(held, 3).when(F.col("ts") < _at("2024-01-15"), 1).otherwise(2)
    events.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{root}/in")
    for n in (1, 2, 3, 3):
        clicks_so_far = click_stream.read_clicks(spark, f"{root}/in/delivery=[1-{n}]")
        late_clicks.split_available(clicks_so_far, f"{root}/out", f"{root}/checkpoint")
    return f"{root}/out"


EVENTS_DDL = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


@job
def stream_late_events(spark, sf):
    return late_clicks.late_events(spark, _late_clicks(spark, sf), EVENTS_DDL).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value"
    )


@job
def stream_corrected_windows(spark, sf):
    """The windows that are closed in the end, corrected by late events; `corrected` says which."""
    root = _late_clicks(spark, sf)
    corrected = late_clicks.corrections(spark, root, EVENTS_DDL).withColumn("corrected", F.lit(True))
    closed = late_clicks.closed_windows(spark, root).withColumn("corrected", F.lit(False))
    return late_clicks.corrected_windows(closed, corrected)


# --- personal data and features ----------------------------------------------------


@query
def pii_scan(spark, sf):
    return pii.scan(E.table(spark, sf, "documents"), "doc_id", "text")


@query
def pii_masked(spark, sf):
    return E.table(spark, sf, "documents").select("doc_id", pii.mask(F.col("text")).alias("text"))


@query
def pii_columns(spark, sf):
    return pii.classify_columns(E.table(spark, sf, "documents"), ["text", "lang", "source"])


@query
def pii_pseudonyms(spark, sf):
    return E.clientes(spark, sf).select("id", pii.pseudonym(F.col("email"), "s3cr3t|").alias("email_key"))


def _feature_orders(spark, sf):
    return fact.order_revenue(E.transacoes(spark, sf), E.itens(spark, sf), E.CHARGED).select(
        F.col("id_cliente").alias("customer_id"), "data_hora", "receita"
    )


@query
def customer_features(spark, sf):
    return features.customer_features(_feature_orders(spark, sf))


@query
def customer_features_trailing(spark, sf):
    return features.trailing_features(_feature_orders(spark, sf))


@job
def clientes_k_anonymous(spark, sf):
    """Customers with their district, segment and the day of their first order told only as far
    as 20 others share it, without what names them."""
    region = E.table(spark, sf, "nation").join(
        E.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_name").alias("distrito"), F.col("r_name").alias("_regiao"))
    first = E.transacoes(spark, sf).groupBy(F.col("id_cliente").alias("id")).agg(
        F.to_date(F.min("data_hora")).alias("primeira_encomenda")
    )
    rows = E.clientes(spark, sf).join(first, "id", "left").join(region, "distrito", "left").select(
        "distrito", "segmento", "primeira_encomenda", "saldo", "_regiao"
    )
    levels = {
        "primeira_encomenda": anonymity.date_levels(F.col("primeira_encomenda")),
        "distrito": [F.col("_regiao"), F.col("distrito")],
        "segmento": [F.col("segmento")],
    }
    return anonymity.k_anonymous(rows, levels, 20, lambda df: tables.staged(df, "groups")).drop("_regiao")


@query
def product_features(spark, sf):
    return features.product_features(E.produtos(spark, sf), E.itens(spark, sf))


@query
def features_as_of(spark, sf):
    """Each order with what one version of the features knew of its customer at its time.

    Besides the first version, whose rows begin with a month, a second has rows that begin
    on the 15th and end on the 11th, so some days have none."""
    labels = E.transacoes(spark, sf).select(
        F.col("id").alias("order_id"), F.col("id_cliente").alias("customer_id"), "data_hora",
        (F.col("metodo_pagamento") == "1-URGENT").alias("urgent"),
    )
    first = features.customer_features(_feature_orders(spark, sf))
    second = first.withColumns({
        "feature_version": F.lit("v2"), "valid_from": F.date_add("valid_from", 14),
        "valid_to": F.date_add("valid_to", 10),
    })
    both = first.unionByName(second)
    found = features.as_of(labels, both, "data_hora", "v2")
    return found.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))
