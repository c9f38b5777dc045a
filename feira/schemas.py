"""Entity schemas. No reader infers types; money is always decimal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(14, 2)
TOTAL = T.DecimalType(18, 2)
MEASURED = T.DecimalType(28, 10)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _TEXT, _DATE, _TIME = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType()

# Columns each operational table keeps, in table order.
ENTITIES: dict[str, T.StructType] = {
    "clientes": _schema(id=_INT, nome=_TEXT, email=_TEXT, data_registo=_DATE, distrito=_TEXT),
    "produtos": _schema(id=_INT, nome=_TEXT, categoria=_TEXT, preco=PRICE, fornecedor=_TEXT),
    "transacoes": _schema(id=_INT, id_cliente=_INT, data_hora=_TIME, metodo_pagamento=_TEXT),
    "transacao_itens": _schema(
        id=_INT, id_transacao=_INT, id_produto=_INT, quantidade=_INT, preco_unitario=PRICE
    ),
}

# Header of each raw file; the transactions file still carries its item columns.
RAW_HEADERS: dict[str, list[str]] = {name: s.fieldNames() for name, s in ENTITIES.items()}
RAW_HEADERS["transacoes"] = [
    "id", "id_cliente", "id_produto", "quantidade", "data_hora", "metodo_pagamento",
]

DIM_PRODUCTS = _schema(
    id=_INT, nome=_TEXT, categoria=_TEXT, fornecedor=_TEXT, preco=PRICE,
    start_date=T.TimestampType(), end_date=T.TimestampType(), is_current=T.BooleanType(),
)

AUDIT = _schema(
    tabela=_TEXT, ficheiro=_TEXT, data_inicio=T.TimestampType(), data_fim=T.TimestampType(),
    linhas_carregadas=_INT, sucesso=T.BooleanType(), erro=_TEXT,
)


class MissingColumnsError(ValueError):
    """A source lacks columns its table needs."""


def select_required(df: DataFrame, table: str) -> DataFrame:
    """Keep the table's columns, dropping extras; name every missing one."""
    wanted = ENTITIES[table].fieldNames()
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{table}: missing required columns {missing}")
    return df.select(*wanted)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the table and parse leniently: what does not parse becomes NULL."""
    return select_required(df, table).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ENTITIES[table]]
    )
