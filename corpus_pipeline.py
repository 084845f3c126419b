"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

toxicity      documents that the classifier predicts to be toxic go (op 5)
line_dedup    lines repeated across documents go from the texts (op 8)
near_dedup    one document of each near-duplicate component stays (op 2)
decontaminate documents with a window of a benchmark item go (op 3)
packing       what is left is tokenised and packed into sequences (op 7)

A stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.  Each result is written as Parquet under ``spark.checkpoint.dir``
and read again, so a lost executor costs a re-read and no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.common import bound_batches, table
from shelfcast.llm.op2_near_dedup import one_per_component
from shelfcast.llm.op3_decontaminate import drop_contaminated
from shelfcast.llm.op5_toxicity import reject_toxic
from shelfcast.llm.op7_packing import op7_packing
from shelfcast.llm.op8_line_dedup import drop_repeated_lines
from shelfcast.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return op7_packing(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: SQL can't express the trained classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
