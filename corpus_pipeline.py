"""The corpus pipeline: from raw documents to piece ids, each stage over all that the one before it kept.

STAGES are (name, function) pairs. A function takes (spark, docs, sf_dir) and returns the next
documents; all but the last return the columns of `documents`. Every stage is written as
Parquet in the shared folder and read again, so a lost executor repeats tasks of one stage.

Null and empty texts, repeated rows and empty tables go through as each operator says; rows that
a filter does not reject stay as they are, extra columns included. A row is known by its doc_id and
its text, so rows without doc_id or with a doc_id of others are judged by themselves.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import decontaminate, near_dedup, piece_codes, quality, toxicity
from stallbook.llm.common import prepare, table
from stallbook.session import stage

TOXIC_FROM, GOOD_FROM = 0.5, 0.3
# Near copies share so many in a hundred of their shingles.
ALIKE_PERCENT = 80
PIECES = "piece_bpe_32k.model"
# SQL can express neither the trained classifiers nor the MinHash join; tests compare with brute force.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name="__score").where(F.col("__score") < TOXIC_FROM).drop("__score")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, name="__score").where(F.col("__score") >= GOOD_FROM).drop("__score")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest id, rows without id last; of equal rows, one."""
    rows = docs.withColumn("__row", F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    verdict = near_dedup.near_duplicates(rows, key="__row", percent=ALIKE_PERCENT)
    verdict = verdict.where("n_shingles > 0").select("__row", "component_id").distinct()
    # Only groups of several rows have anything to drop.
    groups = verdict.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    alike = verdict.join(groups, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row")
    alike = stage(alike.join(rows.select("__row", "doc_id").distinct(), "__row").withColumn("order", order), "alike")
    first = alike.groupBy("component_id").agg(F.min("order").alias("first"))
    gone = alike.join(first, "component_id").where(F.col("order") != F.col("first")).select("__row")
    kept = rows.join(stage(gone, "copies"), "__row", "left_anti")
    return kept.dropDuplicates(["__row"]).select(*docs.columns)


def not_in_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark contaminates."""
    verdict = decontaminate.verdicts(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    gone = stage(verdict.select(F.col("key").alias("gone"), "row_hash").distinct(), "contaminated")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("gone")) & (F.xxhash64("text") == F.col("row_hash"))
    return docs.join(gone, same, "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces, decoded_crc32, same."""
    return piece_codes.round_trip(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("toxicity", not_toxic),
    ("quality classifier", good),
    ("MinHash near-dedup", without_copies),
    ("benchmark decontamination", not_in_benchmarks),
    ("SentencePiece encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
