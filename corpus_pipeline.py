"""The corpus pipeline: stages over documents, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swinglake.llm import decontamination, jaccard, mixing, toxicity
from swinglake.llm.catalog import write_and_digest
from swinglake.llm.common import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"), toxicity.label_categories())
    return toxicity.without_toxic(docs.select(*COLUMNS), chain)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return jaccard.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontamination.without_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source has a share as the root of its bytes."""
    return mixing.mix(docs).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as ORC; a row per document of what the files hold."""
    return write_and_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", token_ids),
]

# classifiers and tokenizers have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
