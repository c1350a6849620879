"""A training corpus from the table of documents, in five stages.

Toxic documents go, one document of each group of near copies stays, documents with
benchmark passages go, the sources are mixed so that the rare ones are read up to twice
while every document is read at least once, and the result is written as token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinara.llm.decontaminate import drop_contaminated
from opinara.llm.jaccard_join import drop_near_duplicates
from opinara.llm.mixing import mixed_documents
from opinara.llm.queries import for_workers
from opinara.llm.token_files import tokenized
from opinara.llm.toxicity import drop_toxic
from opinara.session import cut_lineage

MAX_REPEATS = 2.0


@for_workers
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@for_workers
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the Jaccard join: five words, similarity 0.8."""
    return drop_near_duplicates(docs)


@for_workers
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@for_workers
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of rare sources up to twice."""
    return mixed_documents(docs, max_repeats=MAX_REPEATS)


@for_workers
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending id order, read back: ``doc_id, start, n_tokens, ids_crc32``."""
    return tokenized(docs)


STAGES = [("toxicity", toxicity), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources", mixing),
          ("token-ID output", token_output)]

#: Trained models, connected classes and tokenizers have no meaning in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
