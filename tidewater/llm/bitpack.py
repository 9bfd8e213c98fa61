"""Token-ID output in fixed-width bit-packed files.

Ids of all documents, in ascending document order, are cut into files by document range. In a file each id takes the
fewest bits that hold the vocabulary. Layout, all numbers little-endian:

    magic (8 bytes), bits (u32), ids per block (u32)
    blocks: ids packed from the lowest bit on; each begins on a byte, only the last one may be short
    index: document ids (i64), null flags (u8) and ends in ids (u64) of each document; offsets of the blocks (u64)
    documents (u64), ids (u64), blocks (u64), place of the index (u64), magic

The block offsets let any range of ids be read alone: the blocks that hold it are unpacked by numpy in one go.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._arrow import slices, text_bytes, white
from tidewater.llm._common import saved, text_of

MAGIC = b"TWBITPK1"
BLOCK = 8192
#: Text that a task encodes at once.
SLICE = 6 << 20
#: Pieces of text whose ids a worker remembers, and the bytes of the longest such piece.
KNOWN, LONGEST = 400_000, 64
FOOTER = "<QQQQ8s"
HEAD = "<8sII"
#: White space beyond ASCII; where a text has any, it is encoded in one piece (see encode_all).
OTHER_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1))
                       .astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flags.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    """Appends documents to one file; holds a block of ids and the index, nothing more."""

    def __init__(self, sink, bits: int, block: int = BLOCK):
        self.sink, self.bits, self.block = sink, bits, block
        self.rest = np.zeros(0, np.uint32)
        self.doc_ids, self.ends, self.offsets, self.n_ids = [], [], [struct.calcsize(HEAD)], 0
        sink.write(struct.pack(HEAD, MAGIC, bits, block))

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.ends.append(self.n_ids + np.cumsum(lengths))
        self.n_ids += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // self.block * self.block
        for at in range(0, whole, self.block):
            self._put(self.rest[at:at + self.block])
        self.rest = self.rest[whole:]

    def _put(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.bits)
        self.sink.write(raw)
        self.offsets.append(self.offsets[-1] + len(raw))

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        ends = np.concatenate(self.ends) if self.ends else np.zeros(0)
        self.sink.write(np.array([x or 0 for x in self.doc_ids], "<i8").tobytes())
        self.sink.write(np.array([x is None for x in self.doc_ids], "u1").tobytes())
        self.sink.write(ends.astype("<u8").tobytes() + np.array(self.offsets, "<u8").tobytes())
        self.sink.write(struct.pack(FOOTER, len(self.doc_ids), self.n_ids, len(self.offsets) - 1, self.offsets[-1], MAGIC))
        self.sink.close()


class Reader:
    """Random access to one file: ``ids(first, last)`` reads and unpacks the blocks of that range only."""

    def __init__(self, path: str):
        fs, at = pafs.FileSystem.from_uri(path)
        self.f = fs.open_input_file(at)
        magic, self.bits, self.block = struct.unpack(HEAD, self.f.read_at(struct.calcsize(HEAD), 0))
        tail = self.f.size() - struct.calcsize(FOOTER)
        self.n_docs, self.n_ids, blocks, index, end = struct.unpack(FOOTER, self.f.read_at(struct.calcsize(FOOTER), tail))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"not a bit-packed id file: {path}")
        raw = self.f.read_at(tail - index, index)
        n = self.n_docs
        nulls = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.doc_ids = [None if x else int(i) for i, x in zip(np.frombuffer(raw, "<i8", n), nulls, strict=True)]
        self.ends = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, 17 * n).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        if first >= last:
            return np.zeros(0, np.uint32)
        one, end = first // self.block, (last - 1) // self.block + 1
        raw = self.f.read_at(int(self.offsets[end] - self.offsets[one]), int(self.offsets[one]))
        width = int(self.offsets[1] - self.offsets[0]) if end - one > 1 else len(raw)
        if self.block * self.bits % 8 == 0 or end - one == 1:  # blocks meet without padding
            found = unpack(raw, min(end * self.block, self.n_ids) - one * self.block, self.bits)
        else:
            found = np.concatenate([unpack(raw[i * width:(i + 1) * width],
                                           min(self.block, self.n_ids - (one + i) * self.block), self.bits)
                                    for i in range(end - one)])
        return found[first - one * self.block:last - one * self.block]


class Encoder:
    """A byte-level tokenizer that remembers the ids of the first ``most`` short pieces it meets; which it remembers
    affects the work only."""

    def __init__(self, tokenizer, most: int = KNOWN):
        self.tokenizer, self.most = tokenizer, most
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character of a token stands for a byte
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.known, self.ids, self.ends = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each piece begin and how many they are. ``pieces``: distinct, none empty."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(at < 0)
        start, n = self.ends[at], self.ends[at + 1] - self.ends[at]
        if not len(new):
            return self.ids, start, n
        others = pieces.take(pa.array(new))
        ids, size = self.encode_new(others)
        start[new], n[new] = len(self.ids) + np.cumsum(size) - size, size
        found = np.concatenate([self.ids, ids])
        short = pc.binary_length(others).to_numpy(zero_copy_only=False) <= LONGEST
        kept = short & (np.cumsum(short) <= self.most - len(self.known))
        if kept.any():
            self.known = pa.concat_arrays([self.known, others.filter(pa.array(kept))])
            self.ids = np.concatenate([self.ids, ids[np.repeat(kept, size)]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size[kept])])
        return found, start, n

    def encode_new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row and how many each has. Pieces that begin with white space and end otherwise
        are encoded many at a time in one string: a cut is safe between them, and the ids' lengths in bytes tell where
        each ends. The others are encoded one by one."""
        raw, offs = text_bytes(pieces)
        length = np.diff(offs)
        blank = white(raw)
        joint = blank[offs[:-1]] & ~blank[offs[1:] - 1]
        together = np.flatnonzero(joint)
        texts = [raw[offs[run[0]]:offs[run[-1] + 1]] if len(run) == run[-1] - run[0] + 1 else
                 np.concatenate([raw[offs[i]:offs[i + 1]] for i in run])
                 for run in np.split(together, np.arange(200, len(together), 200)) if len(run)]
        alone = np.flatnonzero(~joint)
        texts += [raw[offs[i]:offs[i + 1]] for i in alone]
        order = np.concatenate([together, alone])
        found = self.tokenizer.encode_batch_fast([t.tobytes().decode() for t in texts], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        ends = np.cumsum(self.width[ids])
        last = np.searchsorted(ends, np.cumsum(length[order]))
        if len(ids) and (ends[-1] != len(raw) or not np.array_equal(ends[last], np.cumsum(length[order]))):
            raise ValueError("not a byte-level tokenizer")
        n = np.diff(np.concatenate([[-1], last]))
        size = np.zeros(len(length), np.int64)
        size[order] = n
        # Back to the order of the pieces.
        start = np.zeros(len(length), np.int64)
        start[order] = np.cumsum(n) - n
        within = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
        return ids[np.repeat(start, size) + within], size


@lru_cache(maxsize=1)
def encoder_of(path: str, changed: int) -> Encoder:
    """The encoder of a tokenizer file, last changed at ``changed``; a worker keeps it from task to task."""
    from tokenizers import Tokenizer
    return Encoder(Tokenizer.from_file(path))


def encode_all(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and how many each text has; as if every text were encoded whole.

    The tokenizer's own rules cut a text wherever white space follows something else, and what lies between two such
    cuts is encoded without regard to the rest. So equal stretches are encoded once, and not again where the encoder
    knows them from earlier texts. Texts with white space beyond ASCII, where that cut isn't safe, are encoded whole."""
    raw, offs = text_bytes(texts)
    blank = white(raw)
    begins = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1 if len(raw) else np.zeros(0, np.int64)
    odd = np.flatnonzero(pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False))
    if len(odd):
        text_at = np.searchsorted(offs, begins, "right") - 1
        begins = begins[~np.isin(text_at, odd)]
    begins = np.unique(np.concatenate([begins, offs[:-1][np.diff(offs) > 0]]))
    if not len(begins):
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(raw)).astype(np.int64)),
                                              pa.py_buffer(raw))
    coded = pieces.dictionary_encode()
    ids, start, size = encoder.encode(coded.dictionary)
    code = coded.indices.to_numpy()
    n = size[code]
    ends = np.cumsum(n)
    within = np.arange(ends[-1]) - np.repeat(ends - n, n)
    ids = ids[np.repeat(start[code], n) + within]
    total = np.concatenate([[0], ends])
    first = np.searchsorted(begins, offs)
    return ids, total[first[1:]] - total[first[:-1]]


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, in ascending order of ``id_col`` to files in
    ``folder`` (a path or URI that all executors share). Returns the manifest, a row per file: ``part``, ``path``,
    ``n_docs``, ``n_ids``; files of lost or repeated task attempts are not in it.

    A null text counts as empty: only its end id is written. Null ids come first; rows of equal id are ordered by text.
    Other columns are not read. An empty table has an empty manifest."""
    from tokenizers import Tokenizer

    bits = bits_for(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = rows.repartitionByRange(F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        writer, part = None, TaskContext.get().partitionId()
        for batch in batches:
            for run in slices(batch, "text", SLICE):
                if writer is None:
                    encoder = encoder_of(tokenizer_path, os.stat(tokenizer_path).st_mtime_ns)
                    fs, at = pafs.FileSystem.from_uri(folder)
                    fs.create_dir(at)
                    name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.ids"  # a name for each attempt
                    writer = Writer(fs.open_output_stream(f"{at}/{name}"), bits)
                ids, n = encode_all(encoder, run.column(1))
                out = np.full(len(ids) + len(n), end_id, np.uint32)
                place = np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)
                out[place] = ids
                writer.add(run.column(0).to_pylist(), n + 1, out)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name}"],
                                              "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]})

    return saved(rows.mapInArrow(write, "part bigint, path string, n_docs bigint, n_ids bigint"), "ids-manifest")


def read_ids(manifest: DataFrame, id_col: str = "doc_id", at_once: int = 1 << 20) -> DataFrame:
    """Read the files of a manifest back: a row per document with its id, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` (of its ids as little-endian u32). A task holds about ``at_once`` ids at a time,
    or one document. The manifest has a row per file; only that comes to the driver, to sum up where files start."""
    files, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        files.append((r["path"], start))
        start += r["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                f = Reader(path)
                first = 0
                while first < f.n_docs:
                    low = int(f.ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(f.ends, low + at_once, "right")))
                    ends = f.ends[first:last]
                    ids = f.ids(low, int(ends[-1])).astype("<u4")
                    begins = np.concatenate([[low], ends[:-1]])
                    crc = [zlib.crc32(ids[b - low:e - low].tobytes()) for b, e in zip(begins, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[first:last], pa.int64()), pa.array(begins + begin),
                         pa.array(ends - begins), pa.array(crc, pa.int64())],
                        names=["id", "start", "n_tokens", "ids_crc32"])
                    first = last

    spark = manifest.sparkSession
    table = spark.createDataFrame(files, "path string, begin bigint").repartition(max(1, len(files)))
    return (table.mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
            .withColumnRenamed("id", id_col))
