"""The corpus pipeline: documents in, a sharded mixture out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), calls one
operator of ``wreckline.llm`` and returns what it keeps. Stage outputs are written as
Parquet to the cluster's shared folder and read again, so a lost executor costs at most
the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wreckline.llm.common import apart, staged, table, workers_import_package
from wreckline.llm.decontaminate import decontaminate
from wreckline.llm.language_id import ADDED, identify_language
from wreckline.llm.mixing import mixture
from wreckline.llm.ngram_join import keep_one
from wreckline.llm.sharding import shard_rows

SHARDS = 24
#: Near duplicates of this stage: 5-word shingles, Jaccard similarity of at least 0.8.
#: (The contract of ``op3_ngram_join``, 4 words and 85 %, binds that query only.)
NEAR_WIDTH = 5
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that a model knows, or declares one too rare for a model; text
    without one goes."""
    return apart(docs, ADDED, lambda given: identify_language(
        given, F.col("text"), F.col("lang"), F.col("source")).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixture(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their virtual slot and shard."""
    return shard_rows(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("mix", mix),
    ("shard", shard),
]

#: No SQL: language models, edit distances and hashes of slots have no DuckDB counterpart.
#: ``tests/llm/test_pipeline.py`` compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_import_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
