"""Registered queries of the numbered operators: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import op11_search as op11
from shelfcast.llm import op12_fill_in_middle as op12
from shelfcast.llm import op13_exact_dedup as op13
from shelfcast.llm import op1_revisits as op1
from shelfcast.llm import op2_near_dedup as op2
from shelfcast.llm import op3_decontaminate as op3
from shelfcast.llm import op4_licenses as op4
from shelfcast.llm import op8_line_dedup as op8
from shelfcast.llm import op9_embedding_dedup as op9
from shelfcast.llm.common import table
from shelfcast.llm.op10_language import op10_language
from shelfcast.llm.op5_toxicity import op5_toxicity
from shelfcast.llm.op6_training_order import op6_training_order
from shelfcast.llm.op7_packing import op7_packing


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.op1_revisits(table(spark, sf_dir, "pages"))


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.op2_near_dedup(table(spark, sf_dir, "documents"))


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.op3_decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.op4_licenses(table(spark, sf_dir, "documents"))


def q_op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_training_order(table(spark, sf_dir, "documents"))


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_packing(table(spark, sf_dir, "documents"))


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.op8_line_dedup(table(spark, sf_dir, "documents"))


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.op9_embedding_dedup(table(spark, sf_dir, "embeddings"))


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_language(table(spark, sf_dir, "documents"))


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.op11_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.op12_fill_in_middle(table(spark, sf_dir, "documents"))


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.op13_exact_dedup(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_revisits": q_op1,
        "op2_near_dedup": q_op2,
        "op3_decontaminate": q_op3,
        "op4_licenses": q_op4,
        "op5_toxicity": q_op5,
        "op6_training_order": q_op6,
        "op7_packing": q_op7,
        "op8_line_dedup": q_op8,
        "op9_embedding_dedup": q_op9,
        "op10_language": q_op10,
        "op11_search": q_op11,
        "op12_fill_in_middle": q_op12,
        "op13_exact_dedup": q_op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_revisits": op1.ORACLE,
        "op2_near_dedup": op2.ORACLE,
        "op3_decontaminate": op3.ORACLE,
        "op4_licenses": op4.oracle(),
        "op8_line_dedup": op8.ORACLE,
        "op9_embedding_dedup": op9.ORACLE,
        "op11_search": op11.ORACLE,
        "op12_fill_in_middle": op12.ORACLE,
        "op13_exact_dedup": op13.ORACLE,
    }
