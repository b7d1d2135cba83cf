"""A training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents; the last returns the ids to train on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import prepared, table
from strata.llm.decontaminate import drop_contaminated
from strata.llm.jaccard_join import keep_one
from strata.llm.language_id import keep_identified
from strata.llm.sentence_piece import encode
from strata.llm.suffix_dedup import without_repeats
from strata.session import scratch_path


@prepared
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; others, NULL and letterless texts go."""
    return keep_identified(docs)


@prepared
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


@prepared
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 240 bytes that occur again anywhere."""
    return without_repeats(docs)


@prepared
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@prepared
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, round_trip (the ids decode to the text) and ids."""
    return encode(docs, keep=["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "ids")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express these stages; tests compare them with brute force.
ORACLE_SQL = None


@prepared
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
