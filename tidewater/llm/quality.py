"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a text a score s; ordered thresholds cut the score line into grades,
P(grade <= k) = sigmoid(threshold_k - s). All grades share the weights, so what pulls a text down (insults, debris,
repetition) pulls it through every grade. Selection uses the expected grade and the tail probability of good grades.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._arrow import ascending, slices, strings, text_bytes, words
from tidewater.llm._common import broadcast_within

BITS = 18
SIZE = 1 << BITS
BYTES, ROWS = 4 << 20, 20_000


def hashed(values: pa.Array, salt: int) -> np.ndarray:
    """Feature numbers of strings: a polynomial hash of their bytes, another for each ``salt``."""
    raw, offs = text_bytes(values.cast(pa.large_string()))
    length = np.diff(offs)
    power = np.cumprod(np.full(int(length.max(initial=0)) + 1, 0x100000001B3, np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1))
                                                     * power[np.arange(len(raw)) - np.repeat(offs[:-1], length)])])
    h = sums[offs[1:]] - sums[offs[:-1]] + np.uint64(salt * 0x9E3779B97F4A7C15 % 2 ** 64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_features(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word: its letters without regard to case and how they begin, what surrounds them, and capitals.
    Feature numbers, flat, and how many each word has."""
    letters = pc.replace_substring_regex(distinct, r"[^\p{L}]", "")
    shape = pc.utf8_slice_codeunits(pc.replace_substring_regex(pc.replace_substring_regex(
        distinct, r"\p{L}+", "a"), r"[0-9]+", "0"), 0, 12)
    lower, size = pc.utf8_lower(letters), pc.utf8_length(letters).to_numpy()
    upper = pc.and_(pc.equal(letters, pc.utf8_upper(letters)), pc.greater(size, 1)).to_numpy(zero_copy_only=False)
    columns = [hashed(shape, 1), np.where(size > 0, hashed(lower, 2), -1), np.where(upper, 3, -1)]
    columns += [np.where(size > n, hashed(pc.utf8_slice_codeunits(lower, 0, n), n), -1) for n in (4, 5)]
    table = np.stack(columns, axis=1)
    return table[table >= 0], (table >= 0).sum(axis=1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text, flat, and where each text's begin (one more at the end): those of its words,
    how much its words repeat, and its length by powers of two. An empty text has the last two alone."""
    raw, offs = text_bytes(texts)
    begins, ends, n_words = words(raw, offs)
    coded = pc.dictionary_encode(strings(raw, begins, ends))
    flat, n = word_features(coded.dictionary.cast(pa.large_string()))
    start, count = np.cumsum(n) - n, max(len(n), 1)
    text = np.repeat(np.arange(len(n_words)), n_words)
    pairs = ascending(text * count + coded.indices.to_numpy())
    doc, code = pairs // count, pairs % count
    distinct = np.bincount(doc, minlength=len(n_words))
    n = n[code]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(doc, n) * SIZE + flat[np.repeat(start[code], n) + within]
    ratio = np.floor(10 * distinct / np.maximum(n_words, 1)).astype(np.int64)
    length = np.floor(np.log2(n_words + 1)).astype(np.int64)
    own = np.arange(len(n_words)) * SIZE  # numbers 8 to 95 are theirs, 3 is capitals; a hash may fall there too
    key = ascending(np.concatenate([key, own + 8 + ratio + 11 * (length >= 4), own + 32 + length]))
    return (key % SIZE).astype(np.int32), np.searchsorted(key, np.arange(len(n_words) + 1) * SIZE)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, a column each."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def train(at: np.ndarray, begins: np.ndarray, grade: np.ndarray, grades: int, ridge: float = 1e-3, steps: int = 150,
          rate: float = 0.05, min_docs: int = 5) -> Model:
    """Maximum likelihood with a ridge on the weights, by Adam over the whole sample. Features in fewer than
    ``min_docs`` texts of the sample weigh nothing. The thresholds are the first one and the logarithms of the gaps, so
    they stay in order."""
    n = len(grade)
    doc = np.repeat(np.arange(n), np.diff(begins))
    common = np.bincount(at, minlength=SIZE)[at] >= min(min_docs, n)
    at, doc = at[common], doc[common]
    share = (np.cumsum(np.bincount(grade, minlength=grades)) + 0.5) / (n + 1)
    cut = np.log(share[:-1] / np.maximum(1 - share[:-1], 1e-9))
    place = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 0.1))])
    w = np.zeros(SIZE)
    state = [[np.zeros(SIZE), np.zeros(SIZE)], [np.zeros_like(place), np.zeros_like(place)]]
    for step in range(1, steps + 1):
        theta = place[0] + np.concatenate([[0], np.cumsum(np.exp(place[1:]))])
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        s = np.bincount(doc, w[at], minlength=n)
        high, low = sigmoid(edge[grade + 1] - s), sigmoid(edge[grade] - s)
        g = (1 - high - low) / n
        p = np.maximum(high - low, 1e-9)
        by_theta = np.zeros(grades + 1)
        np.add.at(by_theta, grade + 1, -high * (1 - high) / p / n)
        np.add.at(by_theta, grade, low * (1 - low) / p / n)
        by_theta = by_theta[1:-1]
        onward = np.cumsum(by_theta[::-1])[::-1]
        grads = [np.bincount(at, g[doc], minlength=SIZE) + ridge * w,
                 np.concatenate([onward[:1], onward[1:] * np.exp(place[1:])])]
        for x, grad, (m, v) in zip((w, place), grads, state, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(w.astype(np.float32), place[0] + np.concatenate([[0], np.cumsum(np.exp(place[1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", grades: int = 3, max_rows: int = 20_000) -> Model | None:
    """Fit on about ``max_rows`` ratings, picked by a hash of the id. Null grades and those outside 0 .. grades - 1 and
    ratings without a document teach nothing. None if nothing is left."""
    rated = ratings.select(F.col(id_col).alias("rated_id"), F.col(grade_col).cast("int").alias("grade")).where(
        F.col("grade").between(0, grades - 1) & F.col("rated_id").isNotNull())
    share = min(1.0, max_rows / max(rated.count(), 1))
    picked = rated.where(F.pmod(F.xxhash64("rated_id"), F.lit(1_000_003)) < share * 1_000_003)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        broadcast_within(picked, 2 * max_rows), F.col("id") == F.col("rated_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES, ROWS):
                at, begins = features(part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.ListArray.from_arrays(begins.astype(np.int32), pa.array(at))],
                    names=["grade", "key", "at"])

    table = rows.select("text", "grade", F.xxhash64("id", "text").alias("key")).mapInArrow(
        run, "grade int, key bigint, at array<int>").toArrow()
    if not table.num_rows:
        return None
    table = table.sort_by("key")  # the same sums whatever order the rows came in
    at = table.column("at").combine_chunks()
    begins = np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy())])
    return train(at.flatten().to_numpy(), begins, table.column("grade").to_numpy(), grades)


def grade(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", good: int = 2,
          least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: its id, ``expected_grade``, ``tail_probability`` (of grade ``good`` or better) and
    ``keep`` (that probability reaches ``least``).

    Null and empty texts are graded by their length feature alone. Without a model the numbers are null and everything
    is kept. Repeated rows get equal answers; other columns are not read; whole texts of any length count."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES, ROWS):
                n = part.num_rows
                expected, tail = pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())
                keep = np.ones(n, bool)
                if shared.value is not None:
                    at, begins = features(part.column(1))
                    sums = np.concatenate([[0], np.cumsum(shared.value.weights[at], dtype=np.float64)])
                    tails = shared.value.tails(sums[begins[1:]] - sums[begins[:-1]])
                    keep = tails[:, good - 1] >= least
                    expected, tail = pa.array(tails.sum(axis=1)), pa.array(tails[:, good - 1])
                yield pa.RecordBatch.from_arrays([part.column(0), expected, tail, pa.array(keep)],
                                                 names=["id", "expected_grade", "tail_probability", "keep"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, expected_grade double, tail_probability double, keep boolean")
    return out.withColumnRenamed("id", id_col)
