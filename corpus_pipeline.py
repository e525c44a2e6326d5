"""The corpus pipeline: each stage takes what its predecessor kept and calls one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which run writes as Parquet in
the shared folder and reads again as the next stage's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import _io, decontaminate, mixing, ngram_join, quality, shards

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_documents(docs.select(*COLUMNS), quality.train(docs, _io.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, once."""
    return ngram_join.drop_duplicates(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.clean_documents(docs.select(*COLUMNS), _io.table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take_copies(docs.select(*COLUMNS))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return shards.shard_documents(docs.select(*COLUMNS), keep=list(COLUMNS)).select(*COLUMNS, "shard", "slot", "h")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding),
]

#: Trees, random rounding and a space-filling curve aren't expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, whose files are cut by shard; a stage's folder goes once the next one is written."""
    docs, folder = _io.table(spark, sf_dir, "documents"), f"{_io.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        write = out.write.partitionBy("shard") if k == len(STAGES) - 1 else out.write  # its tasks hold runs of the order, and so of a shard or two
        write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}").select(*out.columns)
        if k:
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return docs
