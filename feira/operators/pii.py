"""Personal data in text columns: detection, masking, column classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as personal data, in masking order.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"[0-9]{13,16}",
    "phone": r"\+[0-9]{1,3} ?\(?[0-9]{2,3}\)?[ -]?[0-9]{3}[ -]?[0-9]{3,4}",
    "ipv4": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
}
# A character every match of the kind contains. Text without it skips the pattern.
MARKERS = {"email": "@", "phone": "+", "ipv4": "."}


def _may_hold(c: Column, kind: str) -> Column:
    return F.contains(c, F.lit(MARKERS[kind])) if kind in MARKERS else F.lit(True)


def _count(c: Column, kind: str) -> Column:
    return F.when(_may_hold(c, kind), F.regexp_count(c, F.lit(PATTERNS[kind]))).otherwise(0)


def _holds(c: Column, kind: str) -> Column:
    return _may_hold(c, kind) & c.rlike(PATTERNS[kind])


def scan(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, kind, hits) for each kind found in a row; no shuffle."""
    counts = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), _count(F.col(column), kind).alias("hits"))
            for kind in PATTERNS
        ]
    )
    return df.select(key, F.inline(F.filter(counts, lambda c: c["hits"] > 0)))


def mask(c: Column) -> Column:
    """Replace every occurrence by the name of its kind."""
    def replaced(text: Column, kind: str) -> Column:
        return F.regexp_replace(text, PATTERNS[kind], f"<{kind}>")

    # E-mail is the slow pattern, so only texts with an at sign meet it.
    first, *others = PATTERNS
    without_first = F.when(_may_hold(c, first), replaced(c, first)).otherwise(c)
    return reduce(replaced, others, without_first)


def pseudonym(c: Column, secret: str) -> Column:
    """A stable keyed stand-in for an identifier, usable as a join key."""
    return F.sha2(F.concat(F.lit(secret), c.cast("string")), 256)


def classify_columns(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """(coluna, tipo, linhas, linhas_com_dados, classe) from a single scan.

    A column is classed 'pessoal' for a kind when at least `share` of its rows hold it.
    """
    pairs = [(c, kind) for c in columns for kind in PATTERNS]
    hits = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_holds(F.col(c), kind)).alias(f"h{i}") for i, (c, kind) in enumerate(pairs)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"), F.lit(kind).alias("tipo"), F.col(f"h{i}").alias("hits")
            )
            for i, (c, kind) in enumerate(pairs)
        ]
    )
    return hits.select("n", F.inline(rows)).select(
        "coluna", "tipo",
        F.col("n").alias("linhas"),
        F.col("hits").alias("linhas_com_dados"),
        F.when((F.col("hits") > 0) & (F.col("hits") >= F.lit(share) * F.col("n")), "pessoal")
        .otherwise("limpa").alias("classe"),
    )
