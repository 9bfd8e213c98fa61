"""Exact de-duplication by content sort.

The normalised text is the sort key, as (its first characters, a hash, the whole text): sampled splitters, which need the
first two only and so stay short, range-partition the rows, an external sort within each partition puts equal texts
next to each other, and comparing neighbours in full (not their hashes) forms the groups. The best row of a group stays.

A text with very many copies would fill one range, so its rows are dealt to several (text, salt) sub-groups; the heads
of the sub-groups, a few thousand at most for a text, then go through the same sort once more. Which texts need this
comes from a count over all rows (pre-aggregated per task): at most ``max_hot`` texts can have more than
``rows / max_hot`` copies, which bounds the broadcast list at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._common import WHITE, saved, text_of

#: The sort key, and the part of it that the splitters are sampled from.
KEY, SPLIT = ("start", "hash", "norm", "salt"), ("start", "hash", "salt")
START = 24
#: A hot text is dealt to at most so many sub-groups.
MAX_SALTS = 4096


def normalised(text: Column) -> Column:
    """The text without any white space."""
    return F.regexp_replace(text, WHITE + "+", "")


def _keyed(norm: Column) -> list[Column]:
    return [F.substring(norm, 1, START).alias("start"), F.xxhash64(norm).alias("hash"), norm.alias("norm")]


def _hot_texts(rows: DataFrame, hot_rows: int, max_hot: int) -> DataFrame:
    """(hash, salts): hashes of the texts with very many copies, ``max_hot`` rows at most."""
    keys = rows.select("hash")
    threshold = max(hot_rows, keys.count() // max_hot)
    hot = (keys.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)
           .select("hash", F.least(F.ceil(F.col("n") / hot_rows), F.lit(MAX_SALTS)).cast("int").alias("salts")))
    return saved(hot, "dedup-hot")


def _salted(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the number of sub-groups of their text and their own."""
    return rows.join(F.broadcast(hot), "hash", "left").withColumn("salts", F.coalesce("salts", F.lit(1))).withColumn(
        "salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("id", "len"), F.col("salts"))).otherwise(0).cast("int"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = 1000,
              max_hot: int = 50_000) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: those that ``exact_dedup`` calls ``kept``. The rows
    themselves travel through the sort once; nothing is joined back to the texts."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"),
                       F.length(text_of(text_col)).alias("len"), *_keyed(normalised(text_of(text_col))))
    hot = _hot_texts(rows, hot_rows, max_hot)
    best_first = Window.partitionBy(*KEY).orderBy(F.desc("len"), F.asc_nulls_last("id"))
    again = Window.partitionBy(*KEY[:3]).orderBy(F.desc("len"), F.asc_nulls_last("id"))
    keys = _salted(rows.drop("row"), hot)
    top = (keys.where("salts > 1").repartitionByRange(*SPLIT).withColumn("place", F.row_number().over(best_first))
           .where("place = 1").repartitionByRange(*SPLIT[:2]).withColumn("place", F.row_number().over(again))
           .where("place = 1").select("hash", F.col("salt").alias("top_salt")))
    top = saved(top, "dedup-top")  # a row per hot text
    first = (_salted(rows, hot).repartitionByRange(*SPLIT).withColumn("place", F.row_number().over(best_first))
             .where("place = 1").join(F.broadcast(top), "hash", "left"))
    return first.where("top_salt is null or top_salt = salt").select("row.*")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = 1000,
                max_hot: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id`` (id of the row of its group that stays), ``group_size``,
    ``kept`` and ``text_sha256`` of the normalised text.

    Texts are equal when identical after deleting white space; a null counts as empty, so nulls, empty texts and texts
    of white space only are one group. The row with the most code points in its original text stays, among those the
    smallest id (null ids last). Of wholly repeated rows exactly one is ``kept``. Other columns of ``docs``, whatever
    their names, are not read. An empty table gives an empty result.

    ``hot_rows``: a text with more copies than this (and than rows / ``max_hot``) is dealt to sub-groups.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.length(text_of(text_col)).alias("len"),
                       *_keyed(normalised(text_of(text_col))))
    rows = _salted(rows, _hot_texts(rows, hot_rows, max_hot))
    # The sort of the window is the external sort: its partitions are the sampled ranges, no further exchange is needed.
    best_first = Window.partitionBy(*KEY).orderBy(F.desc("len"), F.asc_nulls_last("id"))
    whole = best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranged = (rows.repartitionByRange(*SPLIT)
              .select("id", "len", "salts", "salt", "start", "hash", "norm",
                      F.row_number().over(best_first).alias("place"), F.first("id").over(whole).alias("head"),
                      F.count(F.lit(1)).over(whole).alias("n"))
              .select("id", "len", "salts", "salt", "hash", "place", "head", "n",
                      F.sha2("norm", 256).alias("text_sha256"),
                      F.when((F.col("salts") > 1) & (F.col("place") == 1), F.col("norm")).alias("head_norm")))
    ranged = saved(ranged, "dedup-rows")

    # Heads of the sub-groups of hot texts: the same sort and neighbour comparison, at most MAX_SALTS rows a text.
    again = Window.partitionBy("hash", "head_norm").orderBy(F.desc("len"), F.asc_nulls_last("id"))
    all_heads = again.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = (ranged.where(F.col("head_norm").isNotNull()).repartitionByRange("hash")
              .select("text_sha256", F.col("id").alias("top"), F.col("salt").alias("top_salt"),
                      F.sum("n").over(all_heads).alias("total"), F.row_number().over(again).alias("place2"))
              .where("place2 = 1").drop("place2"))  # a row per hot text, max_hot at most
    joined = ranged.drop("head_norm", "hash").join(F.broadcast(merged), "text_sha256", "left")
    single = F.col("total").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("head")).otherwise(F.col("top")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        ((F.col("place") == 1) & (single | (F.col("salt") == F.col("top_salt")))).alias("kept"),
        "text_sha256")
