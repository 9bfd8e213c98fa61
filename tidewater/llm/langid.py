"""Language identification by hierarchical discrimination.

First the language family, by one linear support vector machine per family (one versus the rest), then the language
within it, by one machine for each pair of its languages (one versus one), trained on the rows of those two alone, and a
vote. Features
are hashed byte bigrams and trigrams of the whole lower-cased text. Only the text is ever looked at for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidewater.llm._arrow import slices, text_bytes

#: Families of the usual language codes; others form a family of their own together.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "be"),
}
TRI, BI = 12, 10  # bits of the feature tables
WIDTH = (1 << TRI) + (1 << BI)
ROWS, BYTES = 100, 1 << 19


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang.lower().split("-")[0] in langs), "other")


def features(texts: pa.Array) -> np.ndarray:
    """A row of WIDTH numbers per text: square roots of the n-gram counts, of length 1. ASCII characters other than
    letters count as a space, and n-grams with a space inside are left out."""
    raw, offs = text_bytes(pc.utf8_lower(texts))
    other = (raw < 128) & ~((raw >= 97) & (raw <= 122))
    x = np.where(other, 32, raw).astype(np.uint32)
    n = len(offs) - 1
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offs))
    out = np.zeros(n * WIDTH, np.float32)
    for size, bits, begin in ((3, TRI, 0), (2, BI, 1 << TRI)):
        if len(x) < size:
            continue
        gram = np.zeros(len(x) - size + 1, np.uint32)
        for k in range(size):
            gram = gram << np.uint32(8) | x[k:len(x) - size + 1 + k]
        ok = row[:len(gram)] == row[size - 1:]
        ok &= (x[1:len(x) - 1] != 32) if size == 3 else (x[:-1] != 32) | (x[1:] != 32)
        at = (gram * np.uint32(2654435761)) >> np.uint32(32 - bits)
        out += np.bincount(row[:len(gram)][ok] * WIDTH + at[ok] + begin, minlength=n * WIDTH).astype(np.float32)
    out = np.sqrt(out.reshape(n, WIDTH))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def train_svm(x: np.ndarray, signs: np.ndarray, ridge: float = 1e-4, steps: int = 250) -> np.ndarray:
    """Linear machines with squared hinge loss, by accelerated gradient steps: (WIDTH + 1, machines). ``signs`` (rows,
    machines) are 1 or -1, the side of each row."""
    signs = signs.astype(np.float32)
    # Classes weigh alike within each machine, whatever their share of the sample.
    weight = np.where(signs > 0, 0.5 / np.maximum((signs > 0).sum(0), 1), 0.5 / np.maximum((signs < 0).sum(0), 1))
    weight = weight.astype(np.float32)
    w = np.zeros((x.shape[1] + 1, signs.shape[1]), np.float32)
    ahead, rate, t = w.copy(), 0.15, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - signs * (x @ ahead[:-1] + ahead[-1]))
        push = weight * signs * slack
        grad = np.vstack([x.T @ push, push.sum(0, keepdims=True)]) * -2 + ridge * ahead
        new = ahead - rate * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / t2) * (new - w)
        w, t = new, t2
    return w


def train_rest(x: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """One machine per class against the rest."""
    return train_svm(x, np.where(y[:, None] == np.arange(classes), 1, -1))


def train_pairs(x: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """One machine for each pair of classes, in the order of ``combinations``: positive for the first of the two."""
    machines = [np.zeros((x.shape[1] + 1, 0), np.float32)]
    for a, b in combinations(range(classes), 2):
        rows = np.flatnonzero((y == a) | (y == b))
        machines.append(train_svm(x[rows], np.where(y[rows, None] == a, 1, -1)))
    return np.hstack(machines)


def vote(margins: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The class with the most votes of the pairs' machines, ties by summed margins and then by order, and its score:
    the mean of its shares (0 to 1) in its pairs, 1 where there is no other class."""
    votes, sums, score = (np.zeros((len(margins), classes)) for _ in range(3))
    for k, (a, b) in enumerate(combinations(range(classes), 2)):
        m = margins[:, k].astype(float)
        votes[:, a] += m >= 0
        votes[:, b] += m < 0
        sums[:, a] += m
        sums[:, b] -= m
        share = (1 + np.tanh(4 * m)) / 2
        score[:, a] += share
        score[:, b] += 1 - share
    sums[votes < votes.max(axis=1, keepdims=True)] = -np.inf
    best = sums.argmax(axis=1)
    if classes < 2:
        return best, np.ones(len(margins))
    return best, score[np.arange(len(margins)), best] / (classes - 1)


def shares(margins: np.ndarray) -> np.ndarray:
    """The machines' margins as shares that add up to 1."""
    e = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """The families with a machine each, and the languages of each family with a machine for each pair."""
    families: list[str]
    by_family: np.ndarray
    langs: dict[str, list[str]]
    by_lang: dict[str, np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row and its score: share of the family times score of the language within it."""
        step = shares(x @ self.by_family[:-1] + self.by_family[-1])
        family = step.argmax(axis=1)
        out, score = np.empty(len(x), object), step[np.arange(len(x)), family].astype(float)
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            best, within = vote(x[rows] @ self.by_lang[name][:-1] + self.by_lang[name][-1], len(self.langs[name]))
            out[rows] = np.array(self.langs[name], object)[best]
            score[rows] *= within
        return out.tolist(), score


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", max_per_lang: int = 1000) -> Model | None:
    """Fit on a bounded sample: about ``max_per_lang`` rows of each language, picked by a hash of the text (so copies
    fall together). Rows without a language or without a letter teach nothing. None if no row is left."""
    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, max_per_lang / n)).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share * 1_000_003)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES, ROWS):
                x = features(part.column(0))
                row, at = np.nonzero(x)
                ends = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(x[row, at].astype(np.float32)))],
                    names=["lang", "at", "value"])

    table = picked.mapInArrow(run, "lang string, at array<int>, value array<float>").toArrow()
    lang = np.array(table.column("lang").to_pylist(), object)
    x = np.zeros((len(lang), WIDTH), np.float32)
    at, value = table.column("at").combine_chunks(), table.column("value").combine_chunks()
    x[np.repeat(np.arange(len(lang)), pc.list_value_length(at).to_numpy()), at.flatten().to_numpy()] = \
        value.flatten().to_numpy()
    order = np.lexsort((x[:, 0], lang.astype(str)))  # the same sums whatever order the rows came in
    lang, x = lang[order], x[order]
    found = sorted(set(lang))
    if not found:
        return None
    langs: dict[str, list[str]] = {}
    for one in found:
        langs.setdefault(family_of(one), []).append(one)
    families = sorted(langs)
    family = np.array([families.index(family_of(one)) for one in lang])
    by_lang = {}
    for k, name in enumerate(families):
        rows_of = family == k
        by_lang[name] = train_pairs(x[rows_of], np.array([langs[name].index(one) for one in lang[rows_of]]),
                                    len(langs[name]))
    return Model(families, train_rest(x, family, len(families)), langs, by_lang)


def answers(model: Model | None, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
    lang, score = ["und"] * len(letters), np.zeros(len(letters))
    if model is not None:
        lang, score = model.predict(features(texts))
        lang = [one if ok else "und" for one, ok in zip(lang, letters, strict=True)]
        score = np.where(letters, score, 0.0)
    return pa.array(lang, pa.string()), pa.array(score)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred`` and ``score`` (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or where there is no model. Repeated rows get equal
    answers; other columns are not read; whole texts of any length count. A task holds a few MB of text at a time."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BYTES, ROWS):
                yield pa.RecordBatch.from_arrays([part.column(0), *answers(shared.value, part.column(1))],
                                                 names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def annotate(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and those of ``identify``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch, text_col, BYTES, ROWS):
                lang, score = answers(shared.value, part.column(text_at))
                own = batch.slice(done, part.num_rows)  # the texts as they were, nulls too
                done += part.num_rows
                yield pa.RecordBatch.from_arrays([*own.columns, lang, score],
                                                 names=[*own.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)
