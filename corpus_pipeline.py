"""The corpus pipeline: toxicity, quality rules, near-dedup, decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; every stage but the last
returns the columns of ``documents``. A stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import read, stored
from millrace.llm.decontaminate import decontaminated
from millrace.llm.pieces import segment
from millrace.llm.quality import keep
from millrace.llm.queries_pieces import MODEL
from millrace.llm.simhash import near_duplicates
from millrace.llm.toxicity import remove_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression distance calls toxic go; trained on the labelled rows of this input."""
    return remove_toxic(docs, read(spark, sf_dir, "labels"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id."""
    return near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as ids of their best segmentation, with n-best scores and the round trip's outcome."""
    rows = segment(docs.select("doc_id", "text"), MODEL, decoded=False, hide=("text",), at_once=200)
    return rows.select("doc_id", "n_pieces", "score", "nbest_scores", "ids_crc32", "round_trip", "ids")


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Compression distance and sampled dictionaries have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
