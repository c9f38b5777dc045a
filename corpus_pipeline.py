"""A training corpus from raw documents: five stages of operators from feira.llm.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before kept. All but
the last return the columns of documents; the last returns where the pieces of each
document lie in the training sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import decontamination, near_duplicates, packing, personal_data, toxicity
from feira.plans.tables import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Labels of held-out rows are not used."""
    learnt_from = ~toxicity.held_out(F.col("doc_id"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(learnt_from)
    return toxicity.remove_toxic(docs, toxicity.train(docs.where(learnt_from), labels))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of smallest id."""
    return near_duplicates.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    return personal_data.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# A classifier, similarity classes and a tokenizer have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
