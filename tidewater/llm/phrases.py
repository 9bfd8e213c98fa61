"""Phrase collocation mining with mergeable Misra-Gries summaries.

First pass: every n-gram becomes a hash, which names a hash partition and a fingerprint in it. Tasks count the
fingerprints of their slices, and each hash partition merges these counts into one Misra-Gries summary: when it holds
more counters than its capacity (``SLACK`` times its mass over the threshold), the largest count beyond the capacity is
taken from all counters and the empty ones go. What was taken in all stays below the threshold, so every n-gram that is
frequent survives; fingerprints that collide only add to each other. The survivors are marked in a bitmap of fixed size.

Second pass: the n-grams that the bitmap holds, and a few others by chance, are counted as what they are, by their
words, so the result is exact whatever the first pass let through. A bitmap that fills up, on far more data than
``BITMAP_BITS`` allows for, lets more through and changes nothing else.

Scores and containment are joins of the counts, which a hash of (lang, phrase) spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm._arrow import slices, strings, text_bytes, words
from tidewater.llm._common import broadcast_within, saved, text_of

SLICE = 8 << 20
#: The survivors' bitmap, which goes to every task.
BITMAP_BITS = 1 << 27
#: Capacity of a summary over what the guarantee needs.
SLACK = 4
#: Text that falls to one hash partition, about; sets their number.
PART_BYTES = 8 << 20
#: Counts beyond this are kept as this; it only has to exceed any threshold by far.
FULL = 1 << 31

#: Byte classes of the contract: A-Z become small, piece ends a line feed, blanks a space.
TABLE = np.arange(256, dtype=np.uint8)
TABLE[65:91] += 32
TABLE[list(b".,;:!?\x0A\x0B\x0C\x0D")] = 10
TABLE[[9, 32]] = 32


class Words(NamedTuple):
    codes: np.ndarray  # of each word, in ``texts``
    texts: pa.Array
    left: np.ndarray  # words from this one to the end of its piece
    lang: np.ndarray  # of each word, in ``langs``
    langs: pa.Array


def read_words(part: pa.RecordBatch) -> Words:
    """The words of a slice with columns ``text`` and ``lang``."""
    raw, offs = text_bytes(part.column("text"))
    raw = TABLE[raw]
    begins, ends, per_text = words(raw, offs)
    piece = np.cumsum(raw == 10, dtype=np.int64)[begins] if len(raw) else begins
    doc = np.repeat(np.arange(part.num_rows), per_text)
    last = np.ones(len(begins), bool)
    last[:-1] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
    stops = np.flatnonzero(last) + 1
    left = np.repeat(stops, np.diff(stops, prepend=0)) - np.arange(len(begins))
    coded = strings(raw, begins, ends).dictionary_encode()
    langs = part.column("lang").cast(pa.string()).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, left,
                 langs.indices.to_numpy(zero_copy_only=False)[doc], langs.dictionary)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _hashes(values: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in values.to_pylist()], np.uint64)


def gram_keys(w: Words, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n from 1 to ``most``: where n-grams begin, and their hashes (with the language)."""
    own, at = _hashes(w.texts)[w.codes], np.arange(len(w.codes))
    key = _mixed(own + _hashes(w.langs)[w.lang])
    yield 1, at, key
    for n in range(2, most + 1):
        fits = w.left[at] >= n
        at = at[fits]
        key = _mixed(key[fits] * np.uint64(0xD1B54A32D192ED03) + own[at + n - 1])
        yield n, at, key


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending fingerprints and their counts, small."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = np.concatenate([steps, np.minimum(counts, FULL).astype("<u4")]).view(np.uint8).reshape(2, -1, 4)
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes.transpose(0, 2, 1)), asbytes=True)


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    """Fingerprint and count of each entry in one 64-bit number."""
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob, 8 * n, asbytes=True), np.uint8).reshape(2, 4, n)
    both = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]
    return (np.cumsum(both[0], dtype=np.uint64) << np.uint64(32)) | both[1]


def _count(most: int, bits: int):
    """Pass 1 in a task: (part, n, blob) for the hash partitions of each slice."""
    parts = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = [key >> np.uint64(32 - bits) for _, _, key in gram_keys(read_words(part), most)]
                short = np.concatenate(found)
                del found
                short.sort()
                first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(short) else np.zeros(0, int)
                counts = np.diff(first, append=len(short))
                short = short[first]
                cut = np.searchsorted(short, parts)
                held = np.flatnonzero(np.diff(cut))
                own = short.astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(held, pa.int32()), pa.array(np.diff(cut)[held], pa.int32()),
                    pa.array([_packed(own[cut[p]:cut[p + 1]], counts[cut[p]:cut[p + 1]]) for p in held], pa.binary())],
                    names=["part", "n", "blob"])
    return run


class Summary:
    """A Misra-Gries summary: counters that lack at most ``taken`` of the truth, which is below ``threshold``."""

    def __init__(self, threshold: int, slack: int = SLACK, wait: int = 1 << 20):
        self.threshold, self.slack, self.wait = threshold, slack, wait
        self.held, self.more, self.waiting = np.zeros(0, np.uint64), [], 0
        self.mass = self.taken = 0

    def add(self, entries: np.ndarray) -> None:
        """Merge counts of another summary or slice (fingerprint << 32 | count)."""
        self.more.append(entries)
        self.waiting += len(entries)
        self.mass += int((entries & np.uint64(0xFFFFFFFF)).sum())
        if self.waiting >= max(self.wait, len(self.held)):
            self.merge()

    def merge(self) -> None:
        both = np.sort(np.concatenate([self.held, *self.more]))
        self.more, self.waiting = [], 0
        if not len(both):
            return
        value = both >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        counts = np.minimum(np.add.reduceat(both & np.uint64(0xFFFFFFFF), first), FULL)
        value = value[first]
        capacity = self.slack * self.mass // self.threshold + 1
        if len(counts) > capacity:
            less = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            if self.taken + less < self.threshold:  # else the summary grows: the guarantee goes first
                self.taken += less
                value, counts = value[counts > less], counts[counts > less] - np.uint64(less)
        self.held = (value << np.uint64(32)) | counts

    def survivors(self) -> np.ndarray:
        """The fingerprints that may reach the threshold."""
        self.merge()
        return (self.held >> np.uint64(32))[(self.held & np.uint64(0xFFFFFFFF)) + np.uint64(self.taken) >= self.threshold]


def _summarise(threshold: int, part_bits: int):
    """The summaries of a task's hash partitions (rows come in their order), as pieces of the bitmap."""
    def piece(part: int, summary: Summary) -> pa.RecordBatch:
        marks = np.zeros(part_bits, bool)
        marks[(summary.survivors() * np.uint64(part_bits)) >> np.uint64(32)] = True
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()),
                                           pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())],
                                          names=["part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary = None, None
        for batch in batches:
            for part, n, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "blob"))):
                if part != now:
                    if now is not None:
                        yield piece(now, summary)
                    now, summary = part, Summary(threshold)
                summary.add(_unpacked(blob, n))
        if now is not None:
            yield piece(now, summary)
    return run


def frequent_bitmap(docs: DataFrame, most: int, threshold: int, n_bits: int = BITMAP_BITS) -> tuple[np.ndarray, int]:
    """The survivors of the first pass over (lang, text), and the bits of a hash that name its partition."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    bits = min(max(6, (size // PART_BYTES).bit_length()), n_bits.bit_length() - 5)
    part_bits = n_bits >> bits
    counted = docs.mapInArrow(_count(most, bits), "part int, n int, blob binary")
    pieces = (counted.repartition(1 << min(bits, 14), "part").sortWithinPartitions("part")
              .mapInArrow(_summarise(threshold, part_bits), "part int, bits binary"))
    whole = np.zeros(n_bits // 8, np.uint8)
    for r in pieces.toLocalIterator():  # n_bits in all, whatever the size of the table
        whole[r.part * part_bits // 8:(r.part + 1) * part_bits // 8] = np.frombuffer(r.bits, np.uint8)
    return whole, bits


COUNTS = "lang string, phrase string, words int, n long"
PACKS = "part int, lang array<string>, phrase array<string>, words array<int>, n array<long>"


def _count_exactly(most: int, bitmap, bits: int, n_bits: int):
    """Pass 2 in a task: (lang, phrase, words, n) of each slice's marked n-grams, and its words in all (phrase null),
    packed by hash partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bitmap.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w = read_words(part)
                if not len(w.codes):
                    continue
                total = np.bincount(w.lang, minlength=len(w.langs))
                found = [(np.zeros(len(total), np.int32), np.arange(len(total)), pa.nulls(len(total), pa.large_binary()),
                          np.zeros(len(total), np.int32), total)]
                many, before = len(w.texts), None
                for n, at, key in gram_keys(w, most):
                    place = ((key >> np.uint64(32 - bits)) * np.uint64(n_bits >> bits)) >> np.uint64(32)
                    marked = (marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at, key = at[marked], key[marked]
                    if n == 1:
                        exact = w.lang[at].astype(np.int64) * many + w.codes[at]
                    else:  # what is frequent begins and ends with n-grams that are, so these have their ids
                        whole = (before[at] >= 0) & (before[at + 1] >= 0)
                        at, key = at[whole], key[whole]
                        exact = before[at] * many + w.codes[at + n - 1]
                    _, first, ids, counts = np.unique(exact, return_index=True, return_inverse=True, return_counts=True)
                    before = np.full(len(w.codes) + 1, -1, np.int64)
                    before[at] = ids
                    begin = at[first]
                    phrase = [w.texts.take(pa.array(w.codes[begin + k])) for k in range(n)]
                    phrase = pc.binary_join_element_wise(*phrase, pa.scalar(b" ", pa.large_binary())) if n > 1 else phrase[0]
                    found.append(((key[first] >> np.uint64(64 - bits)).astype(np.int32), w.lang[begin], phrase,
                                  np.full(len(begin), n, np.int32), counts))
                parts, langs, phrases, words_, counts = zip(*found)
                parts = np.concatenate(parts)
                order = np.argsort(parts, kind="stable")
                held, cut = np.unique(parts[order], return_index=True)
                cut = pa.array(np.append(cut, len(order)), pa.int32())
                columns = [w.langs.take(pa.array(np.concatenate(langs)[order])),
                           pa.concat_arrays(phrases).take(pa.array(order)).cast(pa.large_string()).cast(pa.string()),
                           pa.array(np.concatenate(words_)[order], pa.int32()),
                           pa.array(np.concatenate(counts)[order], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.int32()), *(pa.ListArray.from_arrays(cut, c) for c in columns)],
                    names=["part", "lang", "phrase", "words", "n"])
    return run


def _add_up(threshold: int):
    """The sums of a task's hash partitions (rows come in their order) that reach the threshold, and those of all words."""
    names = ["lang", "phrase", "words", "n"]

    def sums(tables: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(tables).group_by(names[:3]).aggregate([("n", "sum")])
        return out.select([*names[:3], "n_sum"]).rename_columns(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            out = sums(held)
            yield from out.filter(pc.or_(pc.equal(out["words"], 0), pc.greater_equal(out["n"], threshold))).to_batches()

        now, held, waiting = None, [], 0
        for batch in batches:
            part = batch.column("part").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]).tolist()
            for b, e in zip(cuts[:-1], cuts[1:]):
                if e > b and part[b] != now:
                    if held:
                        yield from done()
                    now, held, waiting = part[b], [], 0
                rows = [batch.column(c).slice(b, e - b).flatten() for c in names]
                held.append(pa.Table.from_arrays(rows, names=names))
                waiting += len(rows[0])
                if waiting > 1 << 20:  # no more is held than what differs
                    held, waiting = [sums(held)], 0
        if held:
            yield from done()
    return run


def count_frequent(docs: DataFrame, most: int = 5, threshold: int = 100, text_col: str = "text", lang_col: str = "lang",
                   n_bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, phrase, words, n): the exact count of every phrase of 1 to ``most`` words that occurs ``threshold`` times
    or more in its language, and a row for each language with all its word occurrences (phrase null, words 0)."""
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       text_of(text_col).alias("text"))
    bitmap, bits = frequent_bitmap(docs, most, threshold, n_bits)
    marks = docs.sparkSession.sparkContext.broadcast(bitmap)
    packs = docs.mapInArrow(_count_exactly(most, marks, bits, n_bits), PACKS)
    counts = saved(packs.repartition(1 << min(bits, 14), "part").sortWithinPartitions("part")
                   .mapInArrow(_add_up(threshold), COUNTS), "phrase-counts")
    marks.destroy()
    return counts


def _long(column: str):
    return F.col(column).cast("decimal(38,0)")


def mine_phrases(docs: DataFrame, most: int = 5, threshold: int = 100, top: int = 2000, text_col: str = "text",
                 lang_col: str = "lang", n_bits: int = BITMAP_BITS) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``most`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase lies within a piece (what ``.,;:!?`` and line ends leave) and counts wherever it begins, overlaps
    included. Its score is the least of floor(1000 * a * n / (l * r)) over its cuts into two parts (the smallest first
    part wins ties). A phrase goes if a longer frequent one holds it and occurs as often. Ties of score and a are
    ranked by the phrase's bytes.

    A null language is ``und``, a null or empty text has no words; the same text in several rows counts as often.
    A language without a frequent phrase has no rows, an empty table gives an empty result. Other columns of ``docs``,
    whatever their names, are not read. A text of any length is one row in one task.
    """
    counts = count_frequent(docs, most, threshold, text_col, lang_col, n_bits)
    found = counts.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    totals = broadcast_within(counts.where("words = 0").select("lang", F.col("n").alias("total")), 10_000)
    parts = counts.where((F.col("words") >= 1) & (F.col("words") < most)).select("lang", "phrase", "n")

    inside = (found.where("words >= 3")
              .select("lang", "a", "phrase", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
              .select("lang", "a", F.explode(F.expr(
                  "transform(sequence(0, words - size), i -> array_join(slice(split(phrase, ' '), i + 1, size), ' '))"))
                  .alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
    found = found.join(inside, ["lang", "phrase"], "left").where("around is null or around < a").drop("around")

    cuts = found.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left_part"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right_part"))
    left = parts.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).join(totals, "lang")
    scored = scored.select("lang", "phrase", "a", "k", "l", "r", "total",
                           (_long("a") * _long("total") * F.lit(1000)).alias("above"),
                           (_long("l") * _long("r")).alias("below"))
    scored = scored.withColumn("score", F.expr("cast(above div below as bigint)"))
    least = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "total")).alias("x"))
    best_first = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("x.a"), F.asc("phrase"))
    ranked = least.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "x.a", "x.l", "x.r",
                         F.col("x.total").alias("n"), "x.score")
