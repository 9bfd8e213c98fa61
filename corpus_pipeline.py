"""Corpus pipeline: language ID, exact dedup, n-gram Jaccard join, benchmark decontamination, packing.

Every stage is (spark, docs, sf_dir) -> DataFrame and works on all rows that the one before it kept; all but the last
return the columns of ``documents``. Null, empty and blank texts have no letter and go in the first stage; an empty
table passes through all of them. Every row is a document of its own, rows with a null or a shared id too: the stages
that drop some (n-gram Jaccard join and decontamination) give each row a key, and ids only decide which copy stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontam, exact_dedup, jaccard_join, langid, packing, token_count
from tidewater.llm._common import broadcast_within, saved, small_batches
from tidewater.tables import load

#: Most row keys that are broadcast; with more, Spark shuffles the join.
MAX_BROADCAST = 1_000_000
ROW = "pipeline_row"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its own in each row, written once, so that it is the same for all who read it."""
    return saved(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` (from keyed) without those whose keys are in ``gone``, and without the key."""
    gone = saved(gone.select(ROW), "pipeline-gone")
    return rows.join(broadcast_within(gone, MAX_BROADCAST), ROW, "left_anti").drop(ROW)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no identifiable language go: those without any letter."""
    small_batches(spark)
    return langid.annotate(docs, langid.fit(docs)).where("lang_pred <> 'und'").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id."""
    return exact_dedup.kept_rows(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by Jaccard similarity 0.8 of 5-word shingles, the smallest id stays; a null id only where
    there is no other, and one row where several have the smallest."""
    small_batches(spark)
    rows = keyed(docs)
    linked = saved(jaccard_join.join_components(rows, id_col=ROW).where(F.col(ROW) != F.col("component_id"))
                   .select(ROW, "component_id"), "pipeline-linked")
    firsts = linked.select("component_id").distinct()  # a component's first row isn't linked with an earlier one
    members = saved(linked.unionByName(firsts.withColumn(ROW, F.col("component_id"))), "pipeline-members")
    members = rows.select(ROW, "doc_id").join(broadcast_within(members, MAX_BROADCAST), ROW)
    best = saved(members.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("best"))
        .select(F.col(f"best.{ROW}").alias(ROW)), "pipeline-best")
    return without(rows, members.join(broadcast_within(best, MAX_BROADCAST), ROW, "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    rows = keyed(docs)
    return without(rows, decontam.decontaminate(rows, load(spark, sf_dir, "benchmark"), id_col=ROW).where("contaminated"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies: bucket, shard, batch and place."""
    small_batches(spark)
    return packing.pack_tokens(docs, token_count.vocabulary())


STAGES = [("language ID", language_stage), ("exact dedup", dedup_stage), ("n-gram Jaccard join", near_duplicate_stage),
          ("benchmark decontamination", decontamination_stage), ("packing", packing_stage)]

#: Language ID is a trained model; SQL can't express it. Tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
