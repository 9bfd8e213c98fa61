"""Token counts by a linear longest-match automaton.

The vocabulary is a trie whose nodes carry failure links: where the trie can't go on, the link leads to the node for
what remains after the longest-match pieces of the text so far have been taken off, and a count stored with the link
says how many pieces that were. One pass over a word therefore gives the number of pieces that greedy longest match
would cut, without building a piece and without going back in the word.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._arrow import slices, strings, text_bytes, words


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; read where it is installed, never copied."""
    import public_tokenizers
    return public_tokenizers.path(name)


def vocabulary() -> list[bytes]:
    """The pieces that token counts and lengths go by."""
    return read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a vocabulary file with one base64 piece and its rank per line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


@dataclass(frozen=True)
class Automaton:
    """Nodes are numbers, 0 the root. ``edges`` are sorted node * 256 + byte, ``to`` their ends; ``link`` is the failure
    link (-1: none) and ``popped`` the pieces that following it takes off."""
    edges: np.ndarray
    to: np.ndarray
    link: np.ndarray
    popped: np.ndarray
    start: int

    def step(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by its byte; -1 where there is none."""
        key = nodes.astype(np.int64) * 256 + byte
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.to[at], -1)


def build(vocabulary: Iterable[bytes], word_prefix: bytes = b" ") -> Automaton:
    """The automaton of a vocabulary. Every word is read with ``word_prefix`` before it, so pieces that begin with the
    prefix are the word-initial ones and the others continue a word. ``start`` is the node after the prefix (the root,
    if no piece begins with it)."""
    child: dict[tuple[int, int], int] = {}
    parents, final = [(0, 0)], [False]
    for piece in vocabulary:
        node = 0
        for byte in piece:
            nxt = child.get((node, byte))
            if nxt is None:
                nxt = child[node, byte] = len(final)
                parents.append((node, byte))
                final.append(False)
            node = nxt
        final[node] = True
    final[0] = False
    depth = [0] * len(final)
    for node in range(1, len(final)):  # a parent has a smaller number than its children
        depth[node] = depth[parents[node][0]] + 1
    link, popped = [-1] * len(final), [0] * len(final)
    for node in sorted(range(1, len(final)), key=depth.__getitem__):
        if final[node]:
            link[node], popped[node] = 0, 1
            continue
        above, byte = parents[node]
        back, count = link[above], popped[above]
        while back >= 0 and (back, byte) not in child:
            count += popped[back]
            back = link[back]
        if back >= 0:
            link[node], popped[node] = child[back, byte], count
    keys = np.array([n * 256 + b for n, b in child], np.int64)
    order = np.argsort(keys)
    start = 0
    for byte in word_prefix:
        start = child.get((start, byte), -1) if start >= 0 else -1
    return Automaton(keys[order], np.array(list(child.values()), np.int32)[order], np.array(link, np.int32),
                     np.array(popped, np.int64), max(start, 0))


def piece_counts(auto: Automaton, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Pieces of each word raw[offs[i]:offs[i+1]]; a word that the vocabulary can't spell counts as one unknown piece.
    All words move through the automaton together, a byte at a time."""
    length = np.diff(offs)
    count = np.zeros(len(length), np.int64)
    node = np.full(len(length), auto.start, np.int64)
    order = np.argsort(-length, kind="stable")
    alive = order
    for at in range(int(length.max(initial=0))):
        alive = alive[:np.searchsorted(-length[alive], -at, "left")]  # the words longer than ``at``, longest first
        todo = alive[node[alive] >= 0]
        while len(todo):
            nxt = auto.step(node[todo], raw[offs[todo] + at])
            moved = nxt >= 0
            node[todo[moved]] = nxt[moved]
            todo = todo[~moved]
            count[todo] += auto.popped[node[todo]]
            node[todo] = auto.link[node[todo]]
            todo = todo[node[todo] >= 0]  # no link: not spellable
    todo = np.flatnonzero(node > 0)
    while len(todo):
        count[todo] += auto.popped[node[todo]]
        node[todo] = auto.link[node[todo]]
        todo = todo[node[todo] > 0]
    return np.where(node < 0, 1, count)


def count_tokens(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text",
                 word_prefix: bytes = b" ") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words`` and ``n_tokens``, the greedy longest-match pieces of all words.

    Words are runs without space, \\t \\n \\v \\f \\r. Null and empty texts have no words and no tokens; repeated rows
    are counted each; other columns are not read. Whole texts of any length are read; a task holds a few MB of text at
    a time. The automaton depends on the vocabulary alone and is sent to the executors once."""
    auto = docs.sparkSession.sparkContext.broadcast(build(vocabulary, word_prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offs = text_bytes(part.column(1))
                begins, ends, n_words = words(raw, offs)
                coded = pc.dictionary_encode(strings(raw, begins, ends))
                per_word = np.zeros(0, np.int64)
                if len(begins):
                    distinct = text_bytes(coded.dictionary)
                    per_word = piece_counts(auto.value, *distinct)[coded.indices.to_numpy()]
                sums = np.concatenate([[0], np.cumsum(per_word)])
                at = np.concatenate([[0], np.cumsum(n_words)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()),
                                                  pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())],
                                                 names=["id", "n_words", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_tokens bigint").withColumnRenamed("id", id_col)
