"""The corpus pipeline: five stages, each on all that the one before it kept.

toxicity -> n-gram Jaccard join -> benchmark decontamination -> mixing -> token ids

Every stage is written as Parquet and read again as the next stage's documents.
All but the last return the columns of ``documents``; the last returns the
tokens of each document from the files. The stages cannot be expressed in SQL
(trained model, MinHash, tokenizer): the tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.llm import mixing, near_join, positional_index, token_output, toxicity
from alpina.llm.common import read_table, store, unpacked

#: a document at or above this toxicity score is rejected
TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_FROM``."""
    model = toxicity.toxicity_model(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, keep_rows=True)
    return unpacked(scored.where(F.col("score") < TOXIC_FROM), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_join.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return positional_index.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (whole documents)."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the token files."""
    return token_output.token_round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token-output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: no SQL for the whole: see the module text
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
