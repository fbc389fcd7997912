"""The operators as registered queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    decontaminate,
    hard_negatives,
    language_id,
    line_dedup,
    main_text,
    mixing,
    near_dup,
    periodic_runs,
    quality_rules,
    sql,
    substring_dedup,
    suffix_dedup,
    vector_dedup,
    warc_zip,
)
from strata.llm.shared import table
from strata.llm.ship import ship


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.identify(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_dedup.digest(suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return substring_dedup.digest(substring_dedup.dedup_windows(table(spark, sf_dir, "documents")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.digest(decontaminate.find(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(quality_rules.score(table(spark, sf_dir, "documents")))


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc_zip.digest(warc_zip.round_trip(table(spark, sf_dir, "pages")))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages")
    return main_text.digest(main_text.extract(pages, main_text.fit(pages)))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return hard_negatives.mine(hard_negatives.query_rows(table(spark, sf_dir, "embeddings")))


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return periodic_runs.digest(periodic_runs.find(periodic_runs.plant(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_mixing": op5_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc_zip": op8_warc_zip,
    "op9_near_dup": op9_near_dup,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_dedup": op12_vector_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op4_substring_dedup": sql.op4(),
    "op6_decontamination": sql.op6(),
    "op7_quality_rules": sql.op7(),
    "op8_warc_zip": sql.op8(),
    "op9_near_dup": sql.op9(),
    "op11_hard_negatives": sql.op11(),
    "op12_vector_dedup": sql.op12(),
}
