"""N-gram Jaccard join in the metric space of shingle sets.

1 - Jaccard is a metric, so distances to a few pivots bound all others. Documents are first dealt to neighbourhoods that
no link can leave: with its shingles in one global order, a document is in the neighbourhoods of the first
n - ceil(t n) + 1 of them, and two documents of similarity t or more share one of those. (Far documents share nothing
at all; every distance between them is 1 and no pivot could tell them apart.) Frequent shingles come last in the order,
so neighbourhoods are small but for those of many near copies. Within a neighbourhood:

* up to ``DENSE`` documents: all pairs are candidates;
* more: its most central documents become pivots and the distance of every document to each of them is measured. With
  r = 1 - t, documents within 1 - 2 r of a pivot are dealt to the Voronoi region of their nearest one; any document is
  replicated to the regions of other pivots within 1 - r that are at most 2 r further away than its nearest. Two
  documents within r of each other then meet in the region of either's nearest pivot (triangle inequality), or, if
  neither is near a pivot, in the region of what is far from all. Regions are neighbourhoods again and are joined the
  same way, without the pivots, which are done, and without what is one component already; after ``LEVELS`` of it by
  sliding windows over the documents in order of size.

Before sets are compared, a parity bitmap of each gives a lower bound of their difference.

Candidates are measured exactly; the order of shingles, the choice of pivots and the regions affect the work only.
Documents with equal sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._arrow import ascending, give_back, slices, strings, text_bytes, words
from tidewater.llm._common import broadcast_within, saved

WORDS = 5
#: Similarity in percent: 100 * intersection >= PERCENT * union links two documents.
PERCENT = 80
#: Shingles in so many documents or more count as frequent; the most frequent MAX_FREQUENT of them are known to all
#: tasks. Which they are affects the order of shingles, not the result.
FREQUENT, MAX_FREQUENT = 64, 200_000
DENSE, PIVOTS, LEVELS = 512, 4, 1
#: Bits of the parity bitmap. It tells little of sets of more than LONG shingles; those count common shingles instead.
BITMAP, LONG = 1024, 1000
MAX_BROADCAST = 1_000_000
#: Pairs of rows that a scan lists in one piece, about.
AT_ONCE = 1 << 15
#: Partners of a document that a group of pairs compares in one place; more are dealt to several.
GROUP = 2000


def shingle_sets(texts: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes (64 bits) of each text in ascending order, flat, and where each text's begin.

    Words are runs without space, \\t \\n \\v \\f \\r, with A-Z lower-cased. A text of fewer than ``k`` words has its
    whole sequence as the only shingle; one without words has none."""
    raw, offs = text_bytes(pc.ascii_lower(texts))
    begins, ends, n_words = words(raw, offs)
    coded = pc.dictionary_encode(strings(raw, begins, ends))
    of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = of_word[coded.indices.to_numpy()] if len(begins) else np.zeros(0, np.uint64)
    step, n = np.uint64(0x9E3779B97F4A7C15), max(len(h) - k + 1, 0)
    whole = np.zeros(n, np.uint64)
    for i in range(k):
        whole = whole * step + h[i:i + n]
    last = np.cumsum(n_words)
    out, size = [], np.zeros(len(n_words), np.int64)
    for i in np.flatnonzero(n_words):
        begin, count = last[i] - n_words[i], n_words[i]
        if count >= k:
            one = whole[begin:last[i] - k + 1]
        else:
            one = np.array([xxhash.xxh3_64_intdigest(h[begin:last[i]].tobytes(), seed=int(count))], np.uint64)
        one = one ^ (one >> np.uint64(31))
        one = one * np.uint64(0xBF58476D1CE4E5B9)
        out.append(ascending(one ^ (one >> np.uint64(29))))
        size[i] = len(out[-1])
    return np.concatenate([np.zeros(0, np.uint64), *out]), np.concatenate([[0], np.cumsum(size)])


def frequent_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles in ascending order, and the rank of each by frequency. Tasks count over all documents and
    report what they see twice within a few MB of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                flat = np.sort(shingle_sets(part.column(1), k)[0])
                at = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, int)
                n = np.diff(np.append(at, len(flat)))
                yield pa.RecordBatch.from_arrays([pa.array(flat[at][n > 1].view(np.int64)),
                                                  pa.array(n[n > 1].astype(np.int64))], names=["shingle", "n"])

    rows = (docs.mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT).toArrow())
    shingle = rows.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], (len(shingle) - order).astype(np.int64)  # the most frequent has the last rank


def describe(docs: DataFrame, frequent, k: int, percent: int) -> DataFrame:
    """``docs`` (id, text) -> id, n (set size), k1, k2 (128 bits that stand for the set), rare (shingles that aren't
    frequent), bitmap (of each residue of the hashes, whether their number is odd), prefix (the first shingles in the
    global order)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value
        for batch in batches:
            for part in slices(batch, "text", rows=5000):
                flat, offs = shingle_sets(part.column(1), k)
                at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
                hot = known[at] == flat if len(known) else np.zeros(len(flat), bool)
                key = np.zeros((len(offs) - 1, 2), np.int64)
                rare, prefixes, size = [], [], []
                bits = np.zeros((len(offs) - 1, BITMAP), np.uint8)
                for i in range(len(offs) - 1):
                    own = slice(offs[i], offs[i + 1])
                    s, f = flat[own], hot[own]
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    key[i] = np.frombuffer(digest, np.int64)
                    n = len(s)
                    bits[i] = np.bincount((s >> np.uint64(40)).astype(np.int64) % BITMAP, minlength=BITMAP) & 1
                    first = n - (percent * n + 99) // 100 + 1 if n else 0
                    calm = s[~f]
                    rare.append(len(calm))
                    chosen = calm[:first]
                    if len(chosen) < first:
                        late = np.argsort(rank[at[own][f]])[:first - len(chosen)]
                        chosen = np.concatenate([chosen, s[f][late]])
                    prefixes.append(chosen)
                    size.append(first)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                prefix = np.concatenate([np.zeros(0, np.uint64), *prefixes]).view(np.int64)
                bitmap = np.packbits(bits, axis=1).view(np.int64)
                width = np.arange(len(bits) + 1, dtype=np.int32) * bitmap.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offs)), pa.array(key[:, 0]), pa.array(key[:, 1]),
                     pa.array(rare, pa.int32()), pa.ListArray.from_arrays(width, pa.array(bitmap.ravel())),
                     pa.ListArray.from_arrays(ends, pa.array(prefix))],
                    names=["id", "n", "k1", "k2", "rare", "bitmap", "prefix"])

    return docs.mapInArrow(run, f"id {kind}, n bigint, k1 bigint, k2 bigint, rare int, bitmap array<bigint>, prefix array<bigint>")


#: Rows of a neighbourhood in, candidates out. kind 0: a pair (a < b); 1: a row of a large neighbourhood, cls in a;
#: 2: a pair with a pivot (b) of it.
FOUND = "kind int, bucket bigint, a bigint, b bigint, na bigint, nb bigint, pos int, comp bigint"


def scan(rows: DataFrame, percent: int, dense: int, low: int = 0, high: int = 0, counted: bool = False) -> DataFrame:
    """Candidates of all neighbourhoods of ``rows`` (bucket, cls, n, pos, prio, comp). ``high`` = 0: all pairs of those
    with up to ``dense`` rows; pivot pairs and the rows of larger ones. Otherwise pairs whose places in the
    neighbourhood, in order of size, differ by ``low`` to ``high`` - 1. ``counted``: pairs of long sets are listed for
    each neighbourhood they share, so that these can be counted.

    A task reads its neighbourhoods one after another, sorted by Spark, and keeps ``dense`` or ``high`` rows of one."""
    by = ["prio", "cls"] if not high else ["n", "cls"]
    columns = [c for c in ("bucket", "cls", "n", "pos", "comp") if c in rows.columns]
    rows = rows.select(*columns, "prio").repartition("bucket").sortWithinPartitions("bucket", *by)

    def table(kind, bucket, a, b, na, nb, pos=None, comp=None) -> pa.RecordBatch:
        zero = np.zeros(len(a), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(bucket), pa.array(a), pa.array(b), pa.array(na),
             pa.array(nb), pa.array((zero if pos is None else pos).astype(np.int32)),
             pa.array(zero if comp is None else comp)],
            names=["kind", "bucket", "a", "b", "na", "nb", "pos", "comp"])

    def pairs(x: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        na, nb = x["n"][i], x["n"][j]
        ok = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (x["comp"][i] != x["comp"][j])
        # In the neighbourhood of their first common shingle, all that two documents share begins there.
        least = -(-percent * (na + nb) // (100 + percent))
        early = np.minimum(na - x["pos"][i], nb - x["pos"][j]) >= least
        ok &= early | (np.minimum(na, nb) > LONG) if counted else early
        i, j = i[ok], j[ok]
        swap = x["cls"][i] > x["cls"][j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        return table(0, x["bucket"][i], x["cls"][i], x["cls"][j], x["n"][i], x["n"][j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None  # rows of the neighbourhood that may go on in the next batch
        large = None  # bucket whose pivots (the rows in rest) are chosen already
        for batch in batches:
            x = {c: batch.column(c).to_numpy().astype(np.int64) for c in columns}
            x.setdefault("comp", x["cls"])  # at first each is a component of its own
            old = 0
            if rest is not None:
                old = len(rest["bucket"])
                x = {c: np.concatenate([rest[c], x[c]]) for c in x}
            edge = np.flatnonzero(np.concatenate([[True], x["bucket"][1:] != x["bucket"][:-1], [True]]))
            start, size = edge[:-1], np.diff(edge)
            if high:
                reach = np.repeat(start, size)  # a pair is new if its later row is
                for gap in range(max(low, 1), high):
                    j = np.arange(max(old, gap), len(reach))
                    j = j[j - gap >= reach[j]]
                    if not len(j):
                        break
                    yield pairs(x, j - gap, j)
                tail = max(int(start[-1]), len(reach) - high + 1)
                rest = {c: v[tail:] for c, v in x.items()}
                continue
            big = size > dense
            big[0] |= large is not None  # goes on with any number of rows, after the pivots in rest
            for k in np.flatnonzero(big):
                own = np.arange(start[k], edge[k + 1])
                known = k == 0 and large is not None
                pivot, new = (own[:old], own[old:]) if known else (own[:PIVOTS], own)
                if len(new):
                    yield table(1, x["bucket"][new], x["cls"][new], x["cls"][new], x["n"][new], x["n"][new],
                                x["pos"][new], x["comp"][new])
                for q in pivot:
                    other = new[new != q]
                    yield table(2, x["bucket"][other], x["cls"][other], np.full(len(other), x["cls"][q]),
                                x["n"][other], np.full(len(other), x["n"][q]))
            complete = np.arange(len(start)) < len(start) - 1
            for s in np.unique(size[complete & ~big & (size > 1)]):
                first = start[complete & ~big & (size == s)]
                i, j = np.triu_indices(s, 1)
                some = max(1, AT_ONCE // len(i))
                for f in (first[at:at + some, None] for at in range(0, len(first), some)):
                    for at in range(0, len(i), AT_ONCE):
                        part = slice(at, at + AT_ONCE)
                        yield pairs(x, (f + i[part]).ravel(), (f + j[part]).ravel())
            if big[-1]:
                large, keep = int(x["bucket"][start[-1]]), slice(start[-1], start[-1] + PIVOTS)
            else:
                large, keep = None, slice(start[-1], None)
            rest = {c: v[keep] for c, v in x.items()}
        if rest is not None and not high and large is None and len(rest["bucket"]) > 1:
            i, j = np.triu_indices(len(rest["bucket"]), 1)
            for at in range(0, len(i), AT_ONCE):
                yield pairs(rest, i[at:at + AT_ONCE], j[at:at + AT_ONCE])
        give_back()

    return rows.drop("prio").mapInArrow(run, FOUND)


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cls, members): the sets, as bytes, of ``wanted`` (cls, rep, k1, k2), read from the texts again."""
    rows = docs.join(broadcast_within(wanted, MAX_BROADCAST), F.col("id").eqNullSafe(F.col("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                flat, offs = shingle_sets(part.column("text"), k)
                sets = [flat[offs[i]:offs[i + 1]].tobytes() for i in range(part.num_rows)]
                key = [np.frombuffer(xxhash.xxh3_128_digest(s), np.int64).tolist() for s in sets]
                same = [i for i, (a, b) in enumerate(zip(part.column("k1").to_pylist(), part.column("k2").to_pylist(),
                                                         strict=True)) if key[i] == [a, b]]
                yield pa.RecordBatch.from_arrays([part.column("cls").take(pa.array(same, pa.int64())),
                                                  pa.array([sets[i] for i in same], pa.binary())],
                                                 names=["cls", "members"])

    return rows.select("cls", "text", "k1", "k2").mapInArrow(run, "cls bigint, members binary")


def measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, na, nb, common), exactly. The set of a document is sent once to each group of its partners."""
    pairs = pairs.withColumn("salt", F.lit(0))
    crowded = saved(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs")).where(F.col("pairs") > GROUP),
                    "join-crowded").withColumnRenamed("a", "hub")
    pairs = pairs.join(broadcast_within(crowded, MAX_BROADCAST), F.col("a") == F.col("hub"), "left").select(
        "a", "b", F.when(F.col("hub").isNotNull(), F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / GROUP)))
        .otherwise(0).cast("int").alias("salt"))
    few = broadcast_within(pairs, MAX_BROADCAST)
    partners = sets.join(few, F.col("cls") == F.col("b")).select("a", "salt", "b", "members")
    hubs = sets.join(broadcast_within(pairs.select("a", "salt").distinct(), MAX_BROADCAST), F.col("cls") == F.col("a"))
    rows = (partners.unionByName(hubs.select("a", "salt", F.lit(None).cast("bigint").alias("b"), "members"))
            .repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            out: dict[str, list[int]] = {"a": [], "b": [], "na": [], "nb": [], "common": []}
            for a, b, members in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(),
                                     batch.column("members"), strict=True):
                one = np.frombuffer(members.as_buffer(), np.uint64)
                if b is None:
                    hub = one.copy()
                    continue
                at = np.minimum(np.searchsorted(hub, one), len(hub) - 1)
                for name, value in zip(out, (a, b, len(hub), len(one), int((hub[at] == one).sum())), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in out.items()})
        give_back()

    return rows.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, common bigint")


def components(links: DataFrame) -> DataFrame:
    """(cls, comp): for every document with a link the smallest one it reaches. Labels flow along the links and then
    jump to the label of their label, until nothing changes; each round is written to the shared folder."""
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "join-links")
    labels = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "cls"),
                   "join-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("cls")).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, F.col("cls") == F.col("a")).select(
            "cls", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("cls").alias("above"), F.col("comp").alias("top"))
        new = saved(new.join(up, F.col("comp") == F.col("above")).select(
            "cls", "old", F.least("comp", "top").alias("comp")), "join-labels")
        labels = new.select("cls", "comp")
        if new.where("old <> comp").isEmpty():
            return labels


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                    percent: int = PERCENT, dense: int = DENSE) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` (set size) and ``component_id``, the smallest id reachable
    over links of similarity ``percent`` or more, itself included.

    Null, empty and blank texts have no shingles and are linked with nothing. Texts with equal sets are linked. Null
    ids reach others but are never the smallest, unless nothing else is there. Repeated rows each appear; other columns
    are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, k))
    members = saved(describe(docs, frequent, k, percent), "join-members")
    classes = saved(members.where("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("id").alias("rep"), F.first("rare").alias("rare"), F.first("bitmap").alias("bitmap"),
        F.first("prefix").alias("prefix"))
        .withColumn("cls", F.monotonically_increasing_id()), "join-classes")

    rows = classes.select(F.posexplode("prefix").alias("pos", "bucket"), "cls", F.col("n").cast("int").alias("n"),
                          (1000 * F.col("rare") / F.col("n")).cast("int").alias("prio"))
    bitmaps = classes.select("cls", "bitmap")
    links = None
    known: list[DataFrame] = []  # sets read so far
    tried = None
    comps = None
    level, low, high = 0, 0, 0
    while True:
        found = saved(scan(rows, percent, dense, low, high, counted=level == 0), "join-found")
        pairs = candidates(found, bitmaps, percent, counted=level == 0)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = saved(pairs, "join-pairs")
        merged = False
        if tried is None or not pairs.isEmpty():
            new = saved(measure(pairs, read_sets(docs, classes, pairs, known, k)), "join-measured")
            tried = new if tried is None else tried.unionByName(new)
            fresh = new.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
            links = fresh if links is None else links.unionByName(fresh)
            if comps is None or not fresh.isEmpty():
                comps, merged = components(links), True
        if not high or merged:
            rows = undecided(rows if high else rows_of(found), comps)
            if rows.isEmpty():
                break
            if not high and level < LEVELS:
                rows = undecided(regions(rows, found, tried, percent), comps)
        if high or level == LEVELS:  # pivots are used up: windows of growing width over what is left
            low, high = (1, 65) if not high else (high, 16 * high)
        widest = rows.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
        if widest <= low:
            break
        level += 1

    # Every class has its component's smallest id; every row finds it by its set.
    table = classes.select("cls", "k1", "k2", "rep").join(comps, "cls", "left").withColumn(
        "comp", F.coalesce("comp", "cls"))
    least = table.groupBy("comp").agg(F.min("rep").alias("component_id"))
    table = table.join(least, "comp").select("k1", "k2", "component_id")
    return members.select("id", "n", "k1", "k2").join(table, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def candidates(found: DataFrame, bitmaps: DataFrame, percent: int, counted: bool) -> DataFrame:
    """Distinct pairs of a scan that may be links, and those with pivots that may be within 1 - r.

    By their bitmaps: sets of na and nb members that differ in m or more have a distance of 2 m / (na + nb + m) or more.
    Long sets by c, the neighbourhoods they share: the document whose first shingles end earlier in the global order
    has in common with the other at most the c ones among them and all n - p behind them. c is counted where all pairs
    of a neighbourhood were listed; for larger ones the documents' numbers of those are added."""
    pairs = found.where("kind = 0")
    if counted:
        pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first("na").alias("na"),
                                            F.first("nb").alias("nb"))
        crowd = found.where("kind = 1").groupBy("a").agg(F.count(F.lit(1)).alias("crowds"))
        pairs = (pairs.join(crowd.withColumnsRenamed({"a": "ca", "crowds": "xa"}), F.col("a") == F.col("ca"), "left")
                 .join(crowd.withColumnsRenamed({"a": "cb", "crowds": "xb"}), F.col("b") == F.col("cb"), "left"))
        c = F.col("c") + F.least(F.coalesce("xa", F.lit(0)), F.coalesce("xb", F.lit(0)))
        most = c + F.ceil(F.greatest("na", "nb") * percent / 100) - 1
        pairs = pairs.where((F.least("na", "nb") <= LONG)
                            | (most * (100 + percent) >= percent * (F.col("na") + F.col("nb"))))
    swap = F.col("a") > F.col("b")
    pivots = found.where("kind = 2").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("nb")).otherwise(F.col("na"))
        .alias("na"), F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"), F.lit(True).alias("pivot"))
    both = (pairs.select("a", "b", "na", "nb", F.lit(False).alias("pivot")).unionByName(pivots)
            .groupBy("a", "b", "na", "nb").agg(F.max("pivot").alias("pivot")))
    for side in ("a", "b"):
        both = both.join(bitmaps.withColumnsRenamed({"cls": f"of_{side}", "bitmap": f"bits_{side}"}),
                         F.col(side) == F.col(f"of_{side}"))
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                         lambda x, y: x + y)
    total = F.col("na") + F.col("nb")
    differ = F.greatest(differ, F.abs(F.col("na") - F.col("nb")))
    distance = 2 * differ / (total + differ)
    most = F.when(F.col("pivot"), percent / 100).otherwise(1 - percent / 100)
    return both.where(distance <= most + 1e-9).select("a", "b")


def read_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, known: list[DataFrame], k: int) -> DataFrame:
    """The sets of all documents in ``pairs``; those read before are taken from ``known``, which grows."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    for before in known:
        wanted = wanted.join(before.select("cls"), "cls", "left_anti")
    known.append(saved(sets_of(docs, saved(wanted.join(classes.select("cls", "rep", "k1", "k2"), "cls"),
                                           "join-wanted"), k), "join-sets"))
    out = known[0]
    for more in known[1:]:
        out = out.unionByName(more)
    return out


def rows_of(found: DataFrame) -> DataFrame:
    return found.where("kind = 1").select("bucket", F.col("a").alias("cls"), F.col("na").cast("int").alias("n"), "pos", "comp")


def regions(large: DataFrame, found: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """The regions of large neighbourhoods as new neighbourhoods. Distances to pivots that weren't measured are over
    1 - r; they matter neither for being near nor for replication."""
    r = 1 - percent / 100
    to = found.where("kind = 2").select("bucket", F.col("a").alias("cls"), F.col("b").alias("pivot"))
    far = tried.select(F.col("a").alias("x"), F.col("b").alias("y"),
                       (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("d"))
    to = (to.withColumns({"x": F.least("cls", "pivot"), "y": F.greatest("cls", "pivot")}).join(far, ["x", "y"])
          .groupBy("bucket", "cls").agg(F.array_sort(F.collect_set(F.struct("d", "pivot"))).alias("to")))
    done = found.where("kind = 2").select("bucket", F.col("b").alias("cls")).distinct()
    nearest = F.coalesce(F.col("to")[0]["d"], F.lit(1.0))
    near = nearest <= 1 - 2 * r
    others = F.filter(F.coalesce("to", F.array().cast("array<struct<d:double,pivot:bigint>>")),
                      lambda p: (p["d"] <= F.least(F.lit(1 - r), nearest + 2 * r) + 1e-9))
    rest = F.struct(F.lit(1.0).alias("d"), F.lit(-1).cast("bigint").alias("pivot"))  # far from all pivots
    rows = large.join(to, ["bucket", "cls"], "left").join(done, ["bucket", "cls"], "left_anti")
    return rows.select("bucket", "cls", "n", "pos", "comp", F.explode(
        F.when(near, others).otherwise(F.concat(others, F.array(rest)))).alias("p")).select(
        F.xxhash64("bucket", "p.pivot").alias("bucket"), "cls", "n", "pos", "comp",
        (1000 * F.col("p.d")).cast("int").alias("prio"))


def undecided(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of the neighbourhoods that hold more than one component, with their components as known now."""
    if "prio" not in rows.columns:
        rows = rows.withColumn("prio", F.lit(0))
    rows = rows.drop("comp").join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    rows = saved(rows, "join-rows")
    open_ones = rows.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    return saved(rows.join(open_ones.select("bucket"), "bucket", "left_semi").select(
        "bucket", "cls", "n", "pos", "comp", "prio"), "join-rows")
