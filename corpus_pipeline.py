"""A corpus pipeline of five operators: each stage reads what the one before it kept.

language ID -> line dedup -> MinHash near-dedup -> benchmark decontamination -> mixing. All
stages but the last return the columns of ``documents``; the last adds what the mix takes.
Each row is a document of its own, also where rows share a doc_id or have none; rows with a null doc_id
are never dropped as copies of another document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, language_id, line_dedup, mixing, near_dup
from strata.llm.shared import identified, stored, table
from strata.llm.ship import ship

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row of every document, with a number of the row's own."""
    return identified(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")))


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a recognised language."""
    ship(spark)
    return language_id.recognised(docs, language_id.train(language_id.sample(docs)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated and near-repeated lines; a text that had words and loses them all is dropped."""
    cut = line_dedup.dedup_lines(docs)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = cut.filter((F.col("__n_removed") == 0) | worded)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("__n_removed") > 0, F.length("text"))
                               .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id; of its equal rows, one."""
    ship(spark)
    rows = numbered(docs)
    known = rows.filter("doc_id is not null").select(F.col("__id").alias("doc_id"), "text")
    dropped = near_dup.near_rows(known, SHINGLE, PERCENT).filter("component <> doc_id").select(
        F.col("doc_id").alias("__id"))
    return rows.join(stored(dropped, "near-copies"), "__id", "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage, with or without doc_id."""
    ship(spark)
    rows = numbered(docs)
    found = decontaminate.find(rows.select(F.col("__id").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    dropped = stored(found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("__id")).distinct(), "contaminated")
    return rows.join(dropped, "__id", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with mix_size, mix_target, mix_copies and mix_taken."""
    plan = mixing.plan_mix(stored(mixing.sizes(docs), "mix-sizes"))
    taken = plan.apply(mixing.sizes(docs, F.struct(*docs.columns).alias("row")))
    return taken.filter("copies > 0").select(
        "row.*", F.col("size").alias("mix_size"), F.col("target").alias("mix_target"),
        F.col("copies").alias("mix_copies"), F.col("taken").alias("mix_taken"))


STAGES = [
    ("language_id", recognise_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: A trained network, a signature join and Newton steps have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
