"""Packing into optimal length buckets.

A batch is padded to the length of its bucket. Dynamic programming over the global length histogram chooses the bucket
boundaries that make the padding of the whole corpus smallest; batches within a token budget form inside each bucket.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import token_count
from tidewater.llm._common import WORD, saved, text_of


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def optimal_buckets(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padded length.

    ``histogram``: (length, documents). With lengths l1 < l2 < ... and C the running count of documents, the best cost
    of the first j lengths in k buckets is  l_j * C_j + min over i < j of (cost_{k-1}(i) - l_j * C_i).  In i these are
    lines of falling slope -C_i, asked at rising l_j, so a lower hull answers each in amortised constant time."""
    lengths = sorted((length, n) for length, n in histogram if n > 0)
    if not lengths:
        return []
    size = [x[0] for x in lengths]
    below = [0]
    for _, n in lengths:
        below.append(below[-1] + n)
    m = len(size)
    cost = [0] + [math.inf] * m
    choice: list[list[int]] = []
    for _ in range(min(buckets, m)):
        hull: list[int] = []  # indices i of the lines
        front, new, came = 0, [math.inf] * (m + 1), [0] * (m + 1)
        new[0] = 0
        for j in range(1, m + 1):
            i = j - 1
            if cost[i] < math.inf:
                while len(hull) - front >= 2 and _useless(hull[-2], hull[-1], i, cost, below):
                    hull.pop()
                hull.append(i)
            x = size[j - 1]
            while len(hull) - front >= 2 and cost[hull[front + 1]] - x * below[hull[front + 1]] <= \
                    cost[hull[front]] - x * below[hull[front]]:
                front += 1
            if len(hull) > front:
                i = hull[front]
                new[j], came[j] = x * below[j] + cost[i] - x * below[i], i
        choice.append(came)
        cost = new
    bounds, j = [], m
    for came in reversed(choice):
        if j == 0:
            break
        bounds.append(size[j - 1])
        j = came[j]
    return bounds[::-1]


def _useless(a: int, b: int, c: int, cost: list, below: list) -> bool:
    """Line b is nowhere below both a and c (slopes fall from a to c)."""
    return (cost[c] - cost[a]) * (below[b] - below[a]) <= (cost[b] - cost[a]) * (below[c] - below[a])


def pack(docs: DataFrame, budget: int = 16_384, buckets: int = 16, id_col: str = "doc_id", text_col: str = "text",
         length: Column | None = None, shard_rows: int = 65_536) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens``, ``bucket`` (from 0), ``bucket_len`` (length it is padded to),
    ``shard``, ``batch`` (number within bucket and shard) and ``place`` within the batch, from 0.

    ``length`` gives a row's tokens; by default its words. A batch of a bucket holds ``budget // bucket_len`` rows, one
    at least, so a document longer than the budget is a batch of its own; nothing is cut. Null and empty texts have
    length 0: they are packed like all others, ``budget`` of them to a batch. A bucket is dealt by row hash to
    ceil(rows / shard_rows) shards, so no task orders a whole bucket and each shard has one short batch at most. Ties
    are ordered by id; other columns are not read; an empty table gives an empty result.

    The driver gets the histogram, a row per distinct length: its size is bounded by the longest text, not by the
    number of documents."""
    length = word_count(text_of(text_col)) if length is None else length
    rows = docs.select(F.col(id_col).alias("id"), length.cast("long").alias("n_tokens"))
    histogram = [(r["n_tokens"], r["n"]) for r in rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()]
    bounds = optimal_buckets(histogram, buckets)
    inside = [0] * len(bounds)
    for size, n in histogram:
        inside[bisect_left(bounds, size)] += n

    def per_bucket(values: list[int]) -> Column:
        out = F.lit(values[-1] if values else 0).cast("long")
        for bound, value in reversed(list(zip(bounds[:-1], values[:-1], strict=True))):
            out = F.when(F.col("n_tokens") <= bound, F.lit(value).cast("long")).otherwise(out)
        return out

    fits = per_bucket([max(1, budget // max(1, b)) for b in bounds])
    shards = per_bucket([math.ceil(n / shard_rows) for n in inside] or [1])
    rows = rows.select("id", "n_tokens", per_bucket(list(range(len(bounds)))).cast("int").alias("bucket"),
                       per_bucket(bounds).alias("bucket_len"),
                       F.pmod(F.xxhash64("id"), shards).cast("int").alias("shard"), fits.alias("fits"))
    nth = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("n_tokens", F.asc_nulls_first("id"))) - 1
    return (rows.withColumn("nth", nth)
            .select(F.col("id").alias(id_col), "n_tokens", "bucket", "bucket_len", "shard",
                    F.floor(F.col("nth") / F.col("fits")).alias("batch"),
                    (F.col("nth") % F.col("fits")).cast("int").alias("place")))


def pack_tokens(docs: DataFrame, vocabulary: list[bytes], budget: int = 16_384, buckets: int = 16,
                id_col: str = "doc_id", text_col: str = "text", shard_rows: int = 65_536) -> DataFrame:
    """``pack`` with the tokens of ``token_count.count_tokens`` as lengths: the greedy longest-match pieces of the words
    of a text. They are counted once, for each row by itself, whether ids are null or shared."""
    counted = saved(token_count.count_tokens(docs, vocabulary, id_col, text_col), "packing-tokens")
    return pack(counted, budget, buckets, id_col, length=F.col("n_tokens"), shard_rows=shard_rows)
