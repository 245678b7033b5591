"""A corpus pipeline of five stages, from raw documents to packed training windows.

Every stage takes all rows that its predecessor kept.  All but the last return
the columns of ``documents``; the last returns the pieces of the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm import decontaminate, jaccard, packing, pii, queries, toxicity

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below ``TOXIC`` stay."""
    model = toxicity.train(docs, C.table(spark, sf_dir, "labels"))
    return toxicity.below(docs, model, TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts with a 5-word Jaccard similarity of 0.8 or more, the least id stays."""
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, C.table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the text; ``n_chars`` follows."""
    out = pii.sanitised(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows, with their ids."""
    pieces = packing.pack(docs, queries.byte_bpe())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pii", sanitise),
    ("packing", pack),
]

# Scores, tilings, statistics and token ids have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next stage."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.store(stage(spark, docs, sf_dir), C.work_dir(spark, f"pipeline_{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
