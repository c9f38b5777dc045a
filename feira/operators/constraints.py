"""Constraints that loads may break: uniqueness, foreign keys and missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.operators.merge import duplicate_keys
from feira.schemas import ENTITIES

# Child column -> parent table, and the unique columns of each table.
FOREIGN_KEYS = {
    ("transacoes", "id_cliente"): "clientes",
    ("transacao_itens", "id_transacao"): "transacoes",
    ("transacao_itens", "id_produto"): "produtos",
}
UNIQUE = {
    "clientes": [["id"], ["email"]],
    "produtos": [["id"]],
    "transacoes": [["id"]],
    "transacao_itens": [["id"]],
}


def repeated_keys(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """(tabela, restricao, valor, linhas) of every key found more than once."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return duplicate_keys(df.where(known), *columns).select(
        F.lit(name).alias("tabela"),
        F.lit(f"unique({','.join(columns)})").alias("restricao"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("valor"),
        F.col("rows").alias("linhas"),
    )


def orphans(name: str, child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """(tabela, restricao, valor, linhas) of child keys without a parent.

    Child rows are counted per key before the anti join, so a hot key is one row in it.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))
    lost = used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
    return lost.select(
        F.lit(name).alias("tabela"),
        F.lit(f"foreign key({column})").alias("restricao"),
        F.col(column).cast("string").alias("valor"),
        "linhas",
    )


def broken_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """All breaches among the given tables."""
    found = [
        repeated_keys(name, df, columns)
        for name, df in tables.items()
        for columns in UNIQUE[name]
        if set(columns) <= set(df.columns)
    ] + [
        orphans(child, tables[child], column, tables[parent])
        for (child, column), parent in FOREIGN_KEYS.items()
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, found)


MAP_BYTES = 256 << 20  # of the map of a parent's keys, up to which children meet it unshuffled
MAP_ROW = 4096


def key_map(parent: DataFrame, key: str = "id") -> DataFrame:
    """(part, bits): which whole numbers are keys of parent, one bit each. Equal parts of all
    tasks are combined before they are shuffled."""
    k = F.col(key)
    return parent.where(k.isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits")
    )


def _has_bit(bits: Column, key: Column) -> Column:
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def _with_orphans(child: DataFrame, column: str, parent: DataFrame, mark: str) -> DataFrame:
    """child with a mark on rows whose key has no parent.

    Keys that lie close to each other make a small map, which all tasks get, so the child is
    not shuffled; the map is counted first. Beyond MAP_BYTES, or for keys that are no
    whole numbers, keys of both sides meet in a join.
    """
    if child.schema[column].dataType.typeName() in ("long", "integer", "short", "byte"):
        bits = key_map(parent)
        if bits.count() * MAP_ROW <= MAP_BYTES:
            mapped = bits.select(F.col("part").alias("_part"), F.col("bits").alias("_bits"))
            met = child.join(F.broadcast(mapped), F.bitmap_bucket_number(F.col(column)) == F.col("_part"), "left")
            known = F.coalesce(_has_bit(F.col("_bits"), F.col(column)), F.lit(False))
            return met.withColumn(mark, F.col(column).isNotNull() & ~known).drop("_part", "_bits")
    keys = parent.select(F.col("id").alias("_key")).where("_key is not null").distinct().withColumn("_known", F.lit(True))
    met = child.join(keys, F.col(column) == F.col("_key"), "left")
    return met.withColumn(mark, F.col(column).isNotNull() & F.col("_known").isNull()).drop("_key", "_known")


def breaches(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, restricao, valor, linhas) of all constraints: keys found more than once, keys
    without a parent, and columns with missing values.

    Each table is scanned once: a row gives its keys and whatever it breaks, which are counted
    together. Missing values have no value, and one row for each column.
    """
    found = []
    for name, df in tables.items():
        rows, faults = df, []
        for (child, column), parent in FOREIGN_KEYS.items():
            if child == name and column in df.columns and parent in tables:
                rows = _with_orphans(rows, column, tables[parent], f"_lost_{column}")
                faults.append(F.when(F.col(f"_lost_{column}"), F.struct(
                    F.lit(f"foreign key({column})").alias("restricao"), F.col(column).cast("string").alias("valor"))))
        for columns in UNIQUE[name]:
            if set(columns) <= set(df.columns):
                known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
                value = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
                faults.append(F.when(known, F.struct(
                    F.lit(f"unique({','.join(columns)})").alias("restricao"), value.alias("valor"))))
        for column in ENTITIES[name].names:
            if column in df.columns:
                faults.append(F.when(F.col(column).isNull(), F.struct(
                    F.lit(f"not null({column})").alias("restricao"), F.lit(None).cast("string").alias("valor"))))
        each = rows.select(F.inline(F.array_compact(F.array(*faults))))
        counted = each.groupBy("restricao", "valor").agg(F.count(F.lit(1)).alias("linhas"))
        broken = ~F.startswith("restricao", F.lit("unique")) | (F.col("linhas") > 1)
        found.append(counted.where(broken).select(F.lit(name).alias("tabela"), "restricao", "valor", "linhas"))
    return reduce(DataFrame.unionByName, found)
