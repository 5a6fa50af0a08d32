"""The corpus pipeline: language ID, near-duplicate removal, benchmark
decontamination, mixing and sharding of the documents.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet under the shared folder and read again as the next stage's ``docs``. All
stages but the last return the columns of ``docs``:

* ``language_id`` drops the rows whose language isn't recognised. The model learns
  from the stage's own labelled rows (``lang``).
* ``near_duplicates`` keeps one row of each group of linked 5-word-shingle sets.
* ``decontaminate`` drops the rows that hold a benchmark passage.
* ``mix`` keeps every row and puts the rows in the order of the schedule: files in
  ``part-`` order, rows in file order.
* ``shard`` adds size, shard and slot; columns of the documents with these names give
  way. It cuts the order of the files into stretches of nearly equal bytes, so by
  shard and slot the rows stand in the order of the mix.

A stage given an empty table returns an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import decontaminate as leaks
from keelson.llm import langid, mixing, ngram_join, sharding
from keelson.llm.columns import in_file_order
from keelson.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(spark, langid.train(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_groups(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.mix(spark, docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ["size", "shard", "slot"]
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added]
    return sharding.cut_in_order(spark, in_file_order(docs)).select(*own, *added)


STAGES = [
    ("language ID", language_id),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# A trained language model isn't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{n}")
    return STAGES[-1][1](spark, docs, sf_dir)
