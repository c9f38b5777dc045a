"""The operators of this subpackage as queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import (
    decontamination, fingerprints, infilling, licenses, near_duplicates, packing, pages, personal_data,
    quality, resampling, tokens, toxicity, warc,
)
from feira.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_best_fit_packing(spark, sf):
    return packing.pack(
        table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query
def op2_decontamination(spark, sf):
    found = decontamination.find_matches(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op3_warc(spark, sf):
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op4_fingerprints(spark, sf):
    return fingerprints.fingerprint_edits(table(spark, sf, "documents"))


@query
def op5_near_duplicates(spark, sf):
    return near_duplicates.classes(table(spark, sf, "documents"))


@query
def op6_licenses(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return licenses.scan(docs).select("doc_id", *[f"licenses.{n}" for n in names])


@query
def op7_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_personal_data(spark, sf):
    found = personal_data.personal_data(table(spark, sf, "documents"), ["doc_id"])
    base = F.filter("spans", lambda c: c["base"])
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("spans", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
            for kind in personal_data.BASE
        ],
        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
        personal_data.listed(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query
def op9_main_text(spark, sf):
    return pages.main_text(table(spark, sf, "pages"))


@query
def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs.where(~held_out), table(spark, sf, "labels").where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
        toxicity.rejected(model, F.col("lang"), F.col("score")).alias("rejected"),
    )


@query
def op11_importance_resampling(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


@query
def op12_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = quality.held_out(F.col("doc_id"))
    model = quality.train(docs, table(spark, sf, "labels").where(~held_out))
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query
def op13_fill_in_middle(spark, sf):
    return infilling.digests(table(spark, sf, "documents"))
