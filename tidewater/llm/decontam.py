"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a short run of tokens that looks at some positions and ignores the others, so two runs that
differ only where the mask doesn't look have the same hash. All windows of the documents are hashed under every mask
and joined with the hashes of the benchmark; around each hit the two token sequences are aligned and compared position
by position, which tolerates substituted tokens.

The two masks below find every pair of aligned 13-token windows with up to 2 substitutions: for any two positions of
13, one of the masks can be placed in the window so that it looks at neither (tests try them all). So the result
follows from the definition alone: a document is contaminated if, aligned with some item, 11 of 13 consecutive tokens
agree. Items of fewer than 13 tokens have to occur unchanged and whole.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._common import broadcast_within, saved, text_of

WINDOW, SUBSTITUTIONS = 13, 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
#: Most rows of seeds, items or hit documents that are broadcast; with more, Spark shuffles the join.
MAX_BROADCAST = 1_000_000
NOT_TOKEN = r"[^\p{L}\p{M}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """Hashes of the tokens: lower-cased runs of letters, marks and digits."""
    return F.transform(F.array_remove(F.split(F.lower(text), NOT_TOKEN), ""), lambda t: F.xxhash64(t))


def seed_hashes(h: Column, mask: tuple[int, ...], span: int, key: int) -> Column:
    """The hash of every window of ``span`` tokens under a mask; empty for fewer tokens."""
    def one(i: Column) -> Column:
        return F.xxhash64(F.lit(key), *[F.get(h, i + F.lit(o)) for o in mask])

    return F.when(F.size(h) >= span, F.transform(F.sequence(F.lit(0), F.size(h) - span), one)).otherwise(
        F.array().cast("array<bigint>"))


def seeds_of(rows: DataFrame, whole_lengths: list[int]) -> DataFrame:
    """``rows`` (key, h) -> (key, hash, at): both masks, and for each of ``whole_lengths`` a mask of that many tokens
    without gaps, for items too short for the masks."""
    out = None
    masks = [(m, SPAN) for m in MASKS] + [(tuple(range(n)), n) for n in whole_lengths]
    both = F.concat(*[seed_hashes(F.col("h"), m, SPAN, k) for k, m in enumerate(MASKS)])
    # Windows of one span: both masks in one array, whose second half repeats the positions.
    n = F.size("h") - SPAN + 1
    out = (rows.select("key", n.alias("n"), F.posexplode(both).alias("at", "hash"))
           .select("key", "hash", F.when(F.col("at") >= F.col("n"), F.col("at") - F.col("n")).otherwise(F.col("at"))
                   .alias("at")))
    for k, (mask, span) in enumerate(masks[len(MASKS):], len(MASKS)):
        out = out.unionByName(rows.select("key", F.posexplode(seed_hashes(F.col("h"), mask, span, k))
                                          .alias("at", "hash")).select("key", "hash", "at"))
    return out


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, ih): items with tokens under a number of their own; those with the same tokens are one, with
    their smallest id, or null if none of them has one."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), token_hashes(text_of(text_col)).alias("ih"))
    items = rows.where(F.size("ih") > 0).groupBy("ih").agg(F.min("item_id").alias("item_id"))
    return saved(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "ih"), "decontam-items")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Verified overlaps: (key, item, item_id, diagonal, n_matched), the item's token k lying on the document's token
    k + diagonal, with the tokens that agree over the whole overlap."""
    rows = docs.select(F.col(id_col).alias("key"), text_of(text_col).alias("text"))
    items = benchmark_items(benchmark, item_col, item_text_col)
    short = sorted(r["n"] for r in items.select(F.size("ih").alias("n")).where(F.col("n") < SPAN).distinct().collect())
    few = broadcast_within(items, MAX_BROADCAST)
    item_seeds = saved(seeds_of(items.select(F.col("item").alias("key"), F.col("ih").alias("h")), short)
                       .select(F.col("key").alias("item"), "hash", F.col("at").alias("item_at")), "decontam-seeds")
    windows = seeds_of(rows.select("key", token_hashes(F.col("text")).alias("h")), short)
    hits = saved(windows.join(broadcast_within(item_seeds, MAX_BROADCAST), "hash")
                 .select("key", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct(),
                 "decontam-hits")
    per_doc = (hits.groupBy("key").agg(F.collect_list(F.struct("item", "diagonal")).alias("hits"))
               .withColumnRenamed("key", "hit_key"))
    found = (rows.join(broadcast_within(per_doc, MAX_BROADCAST), F.col("key").eqNullSafe(F.col("hit_key")))
             .select("key", token_hashes(F.col("text")).alias("h"), "hits")
             .select("key", "h", F.inline("hits")).join(few, "item"))
    h, ih, d = F.col("h"), F.col("ih"), F.col("diagonal")
    first, last = F.greatest(F.lit(0), -d), F.least(F.size(ih), F.size(h) - d)
    same = F.when(last > first, F.transform(F.sequence(first, last - 1), lambda k: F.when(
        F.get(ih, k) == F.get(h, k + d), 1).otherwise(0))).otherwise(F.array().cast("array<int>"))
    found = found.select("key", "item", "item_id", "diagonal", F.size("ih").alias("n"), same.alias("same"))
    window = F.least(F.col("n"), F.lit(WINDOW))
    needed = F.when(F.col("n") >= WINDOW, WINDOW - SUBSTITUTIONS).otherwise(F.col("n"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    leak = F.when(F.size("same") >= window, F.exists(
        F.sequence(F.lit(1), F.size("same") - window + 1),
        lambda s: total(F.slice("same", s, window)) >= needed)).otherwise(False)
    return found.where(leak).select("key", "item", "item_id", "diagonal", total(F.col("same")).alias("n_matched"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``contaminated``, ``n_items`` (distinct items found in it), ``item_id``
    (the item with the most agreeing tokens, ties to the smallest) and ``n_matched`` (those tokens; 0 without any).

    Null and empty texts and items have no tokens and match nothing; items with equal tokens count as one, those that
    share an id but not their tokens each; an item with a null id counts like others, and ``item_id`` is null where it
    has more agreeing tokens than any with an id. Rows that share an id (nulls too) are judged together. Empty tables give empty or clean results; other columns are not read.
    """
    per_doc = (overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col)
               .groupBy("key", "item", "item_id").agg(F.max("n_matched").alias("n_matched"))
               .groupBy("key").agg(F.count(F.lit(1)).alias("n_items"),
                                   F.max(F.struct("n_matched", -F.col("item_id"))).alias("best")))
    per_doc = per_doc.select(F.col("key").alias("hit_key"), "n_items", F.col("best.n_matched").alias("n_matched"),
                             (-F.col("best")["col2"]).alias("item_id"))
    ids = docs.select(F.col(id_col).alias("key"))
    return (ids.join(per_doc, F.col("key").eqNullSafe(F.col("hit_key")), "left")
            .select(F.col("key").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id",
                    F.coalesce("n_matched", F.lit(0)).cast("int").alias("n_matched")))
