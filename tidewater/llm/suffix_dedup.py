"""Repeated passages through merged Burrows-Wheeler transforms.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier. Three steps find these strings:

1. Windows of ``length`` bytes are dealt by content: the key of a window is the least hash of the short strings in it,
   so equal windows have equal keys, wherever they are. Neighbouring windows mostly share their key; a run of them is
   one string of a little over ``length`` bytes. Keys that only one run has, and once, can't hold a repeat. (Counted over all
   documents; which keys are left is told by a bitmap of fixed size, which on far more data than it allows for lets more
   runs through and changes nothing else.)
2. The runs go to buckets by key. A bucket cuts its distinct strings into shards, builds the Burrows-Wheeler transform
   of each, and merges all by iterative interleave refinement: the order by the first h bytes and the transforms alone
   (no text) give the order by the first h + 2 bytes, as each row's two preceding bytes sort it stably to its next
   place. Nothing is sorted as a text again. Rows that part from all others leave at the depth where they do, which
   is their common prefix; those left in one block at ``length`` are the repeated intervals.
3. Of each interval the earliest place stays; the others' windows are covered, and are put together per document.

Keys with very many runs (a line that a third of all documents hold) are dealt once more, by a hash of each whole
window, so that no bucket holds more than equal windows of them, and equal strings leave each task once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm._arrow import slices, text_bytes
from tidewater.llm._common import free_shuffles, saved, text_of

#: Text that is hashed at once, and the longest text that is not cut for it.
SLICE, LONG = 1 << 18, 1 << 20
#: Bytes of the hashed strings.
SEED = 24
BITMAP_BITS = 1 << 27
#: Bytes of strings that a bucket gets, about, and that one shard of it has at most.
BUCKET, SHARD = 1 << 18, 1 << 16
#: A key with more runs than this (and than all runs / MAX_HOT) is dealt by whole windows.
HOT_RUNS, MAX_HOT = 10_000, 20_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the SEED bytes from each place of ``raw`` on; zeros follow its end."""
    x = np.zeros(len(raw) + SEED, np.uint64)
    x[:len(raw)] = raw
    for step in (1, 2, 4):
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
    n, h = len(raw), np.uint64(0)
    for k in range(0, SEED, 8):
        h = _mixed(x[k:k + n] + h)
    return h


def runs(raw: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one key: key, text, first window (from the text's begin), windows, and whether the key's
    string stands in the run twice: only then can a run hold equal windows itself."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    hashes, wide = _hashes(raw), length - SEED + 1
    least, step = hashes, 1
    while 2 * step <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if wide > step:
        least = np.minimum(least[:step - wide], least[wide - step:])
    windows = np.diff(offs) - length + 1  # of each text; others cross its end
    has = windows > 0
    cut = np.empty(len(least) + 1, bool)
    cut[0] = cut[-1] = True
    np.not_equal(least[1:], least[:-1], out=cut[1:-1])
    cut[offs[:-1][has]] = True
    cut[(offs[:-1] + windows)[has]] = True
    begin = np.flatnonzero(cut)
    n, begin = np.diff(begin), begin[:-1]
    text = np.searchsorted(offs, begin, "right") - 1
    within = begin - offs[text] < windows[text]
    begin, text, n = begin[within], text[within], n[within]
    around = np.lib.stride_tricks.sliding_window_view(hashes, wide)
    left = around[begin].argmin(axis=1)
    right = n - 1 + wide - 1 - around[begin + n - 1][:, ::-1].argmin(axis=1)
    return least[begin], text, begin - offs[text], n, left != right


def pieces(part: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A slice's bytes, where its texts begin, and the place of the first byte in its text: 0, but for a text of over
    ``LONG`` bytes, which comes alone and in pieces that share ``length`` - 1 bytes, so each window is in one."""
    raw, offs = text_bytes(part.column("text"))
    if len(raw) <= LONG or len(offs) > 2:
        yield raw, offs, 0
        return
    for b in range(0, len(raw) - length + 1, LONG):
        own = raw[b:b + LONG + length - 1]
        yield own, np.array([0, len(own)]), b


def _count_keys(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for raw, offs, _ in pieces(part, length):
                    own, _, _, _, twice = runs(raw, offs, length)
                    key, n = np.unique(np.concatenate([own, own[twice]]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))],
                                                     names=["key", "n"])
    return run


def _marks(n_bits: int, parts: int):
    """The pieces of the bitmap (rows come in their order)."""
    def piece_of(piece: int, marks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()),
                                           pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())],
                                          names=["piece", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, marks = n_bits // parts, None, None
        for batch in batches:
            pieces = batch.column("piece").to_numpy()
            place = batch.column("key").to_numpy().view(np.uint64) % np.uint64(own)
            for piece in np.unique(pieces).tolist():
                if piece != now:
                    if now is not None:
                        yield piece_of(now, marks)
                    now, marks = piece, np.zeros(own, bool)
                marks[place[pieces == piece]] = True
        if now is not None:
            yield piece_of(now, marks)
    return run


def repeated_keys(docs: DataFrame, length: int, n_bits: int, hot_runs: int, max_hot: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bitmap of the keys that two runs or more have, the hot keys among them (``max_hot`` at most), and how many
    runs the repeated keys have."""
    counts = docs.mapInArrow(_count_keys(length), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = saved(counts.where("n > 1"), "passage-keys")
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    hot = [r.key for r in counts.where(F.col("n") > max(hot_runs, total // max_hot)).select("key").toLocalIterator()]
    parts = 64
    piece = F.floor(F.pmod("key", F.lit(n_bits)) / (n_bits // parts)).cast("long")  # n_bits is a power of two
    pieces = (counts.select("key", piece.alias("piece")).repartition(parts, "piece").sortWithinPartitions("piece")
              .mapInArrow(_marks(n_bits, parts), "piece long, bits binary"))
    whole = np.zeros(n_bits // 8, np.uint8)
    for r in pieces.toLocalIterator():  # n_bits in all, whatever the size of the table
        own = n_bits // parts // 8
        whole[r.piece * own:(r.piece + 1) * own] |= np.frombuffer(r.bits, np.uint8)
    return whole, np.sort(np.array(hot, np.int64).view(np.uint64)), total


STRING = "bucket int, key long, id long, row long, start long, n long, twice boolean, string binary"
SPAN = "row long, start long, n long"
#: Strings that a task remembers at most, to send equal ones once.
REMEMBERED = 100_000


def _by_window(raw, offs, length, key, text, start, n, twice):
    """The windows of the runs one by one, under hashes of them."""
    text, at = np.repeat(text, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
    data = raw.tobytes()
    key = [xxhash.xxh3_64_intdigest(data[b:b + length]) for b in (offs[text] + at).tolist()]
    return np.array(key, np.uint64), text, at, np.ones(len(at), np.int64), np.zeros(len(at), bool)


def _strings(length: int, marks, hot, n_bits: int, buckets: int):
    """Runs with repeated keys as strings. One that is equal to an earlier string of the task is covered whole and goes
    without its bytes to any bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hottest, known = marks.value, hot.value, {}
        for part in (p for b in batches for p in slices(b, "text", SLICE)):
            for raw, offs, shift in pieces(part, length):
                key = (found := runs(raw, offs, length))[0]
                place = key % np.uint64(n_bits)
                held = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                much = np.isin(key, hottest)
                usual = [x[held & ~much] for x in found]
                if much.any():
                    usual = map(np.concatenate, zip(usual, _by_window(raw, offs, length, *(x[much] for x in found))))
                key, text, start, n, twice = usual
                id, row = (part.column(c).to_numpy()[text] for c in ("id", "row"))
                data, begin = raw.tobytes(), offs[text] + start
                strings = [data[b:e] for b, e in zip(begin.tolist(), (begin + n + length - 1).tolist())]
                start = start + shift
                for i, at in enumerate(zip(id.tolist(), row.tolist(), start.tolist())):
                    if known.setdefault(strings[i], at) < at:
                        strings[i] = None
                    else:
                        known[strings[i]] = at
                if len(known) > REMEMBERED:
                    known.clear()
                # covered runs that follow on each other are one span, which needs no key and goes to any bucket
                gone = np.array([s is None for s in strings], bool)
                joins = np.zeros(len(gone), bool)
                joins[1:] = gone[1:] & gone[:-1] & (text[1:] == text[:-1]) & (start[1:] == (start + n)[:-1])
                first = np.flatnonzero(~joins)
                if not len(first):
                    continue
                n, gone = np.add.reduceat(n, first), gone[first]
                key, id, row, start, twice = (x[first] for x in (key, id, row, start, twice))
                bucket = np.where(gone, _mixed(row.view(np.uint64)), _mixed(key)) % np.uint64(buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.astype(np.int32)), pa.array(np.where(gone, np.uint64(0), key).view(np.int64)),
                     pa.array(np.where(gone, 0, id)), pa.array(row), pa.array(start), pa.array(n), pa.array(twice & ~gone),
                     pa.array([strings[i] for i in first.tolist()], pa.binary())],
                    names=["bucket", "key", "id", "row", "start", "n", "twice", "string"])
    return run


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The Burrows-Wheeler transform of the strings' suffixes, the empty ones too (equal suffixes in the order of their
    strings): the byte before each plus one, or 0 at a string's begin; and where it begins in the strings, each of which
    one more place follows. Sorted by ranks of prefixes whose lengths double."""
    raw = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    size = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(size) - 1
    symbol = raw.astype(np.int64) + len(strings)  # behind the strings' ends, which come first, in their order
    symbol[ends] = np.arange(len(strings))
    bits, place_bits = max(1, int(symbol.max()).bit_length()), len(raw).bit_length()
    known = max(1, (62 - place_bits) // bits)
    rank = symbol.copy()
    for k in range(1, known):
        rank <<= bits
        rank[:-k] |= symbol[k:]
    place = np.arange(len(raw))
    while True:
        both = np.sort((rank << place_bits) | place)
        order = both & ((1 << place_bits) - 1)
        both >>= place_bits
        number = np.zeros(len(raw), np.int64)
        np.cumsum(both[1:] != both[:-1], out=number[1:])
        rank = np.empty(len(raw), np.int64)
        rank[order] = number
        if number[-1] == len(raw) - 1:
            break
        rank <<= place_bits
        rank[:-known] |= rank[known:] >> place_bits
        known *= 2
    before = np.empty(len(raw), np.uint8)
    before[1:] = raw[:-1] + np.uint8(1)  # an end is 0xff, so a begin has 0
    before[0] = 0
    return before[order], order


def _steps(bwt: np.ndarray) -> np.ndarray:
    """For each row of one transform the row of its suffix with the byte before it; -1 at the begin of a string."""
    order = np.argsort(bwt, kind="stable")
    to = np.empty(len(bwt), np.int64)
    to[order] = np.arange(len(bwt))
    to[bwt == 0] = -1
    return to


def merge(transforms: list[np.ndarray], depth: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (numbered through all transforms) in blocks of two and more whose suffixes share their first ``depth`` bytes,
    and the rows' blocks: the interleave of the transforms, refined by two bytes a round. A row of one round is the next
    round's row of the suffix two bytes longer. ``reach`` has the bytes before each row's suffix in its string; rows with
    fewer than ``depth`` can't come to that depth and are left out from the start."""
    bwt = np.concatenate(transforms)
    base = np.cumsum([0] + [len(t) for t in transforms])
    to = np.concatenate([np.where(s < 0, -1, s + b) for s, b in zip(map(_steps, transforms), base)])
    if reach is None:
        reach = np.zeros(len(bwt), np.int64)
        at = to
        for _ in range(depth):
            reach += at >= 0
            at = np.where(at < 0, -1, to[at])
    rows = np.flatnonzero(reach >= depth)
    block = np.zeros(len(rows), np.int32)
    one = (to << 16) | bwt  # where a row goes, and by which bytes
    two = (to[to] << 16) | (bwt[to].astype(np.int64) << 8) | bwt
    for moves in [one] * (depth % 2) + [two] * (depth // 2):
        move = moves[rows]
        order = np.argsort(move.astype(np.uint16), kind="stable")
        move, block = move[order], block[order]
        first = np.ones(len(rows) + 1, bool)
        np.not_equal(((move[1:] ^ move[:-1]) & 0xFFFF) | (block[1:] ^ block[:-1]), 0, out=first[1:-1])
        shared = ~(first[:-1] & first[1:])  # a block of one has parted from all others
        block = np.cumsum(first[:-1], dtype=np.int32)[shared]
        rows = move[shared] >> 16
    return rows, block


def repeats(strings: list[bytes], depth: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose next ``depth`` bytes occur more than once: string, offset, and a number that equal ones share."""
    shards, held = [[]], 0
    for s in strings:
        if held and held + len(s) > shard:
            shards.append([])
            held = 0
        shards[-1].append(s)
        held += len(s) + 1
    done = [transform(x) for x in shards if x]
    if not done:
        return (np.zeros(0, np.int64),) * 3
    sizes = np.cumsum([0] + [len(places) for _, places in done])
    place = np.concatenate([places + b for (_, places), b in zip(done, sizes)])
    begins = np.cumsum([0] + [len(s) + 1 for s in strings])
    string = np.repeat(np.arange(len(strings)), np.diff(begins))[place]
    offset = place - begins[string]
    rows, block = merge([bwt for bwt, _ in done], depth, offset)
    return string[rows], offset[rows], block


def _cover(length: int):
    """The covered windows of a task's buckets (rows come in their order)."""
    def spans(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches).combine_chunks()
        gone = whole.filter(whole["string"].is_null())
        yield from gone.select(["row", "start", "n"]).to_batches()
        whole = whole.filter(whole["string"].is_valid())
        whole = whole.sort_by([("id", "ascending"), ("row", "ascending"), ("start", "ascending")])
        code = whole["string"].combine_chunks().dictionary_encode().indices.to_numpy()
        earliest = np.zeros(len(code), bool)
        earliest[np.unique(code, return_index=True)[1]] = True
        yield from whole.filter(pa.array(~earliest)).select(["row", "start", "n"]).to_batches()
        whole = whole.filter(pa.array(earliest))  # equal strings are one, under their earliest place
        _, key, many = np.unique(whole["key"].to_numpy(), return_inverse=True, return_counts=True)
        # a key's only string shares no window with another
        whole = whole.filter(pa.array((many[key] > 1) | whole["twice"].to_numpy()))
        if not len(whole):
            return
        string, offset, block = repeats(whole["string"].to_pylist(), length)
        id, row = whole["id"].to_numpy(), whole["row"].to_numpy()
        doc = np.cumsum(np.concatenate([[0], (id[1:] != id[:-1]) | (row[1:] != row[:-1])]))
        at = whole["start"].to_numpy()[string] + offset
        order = np.lexsort((at, doc[string], block))
        first = np.ones(len(order), bool)
        first[1:] = block[order][1:] != block[order][:-1]
        # a run of equal bytes holds one string more than once, and neighbours of one text overlap: one place, one window
        same = np.zeros(len(order), bool)
        same[1:] = ~first[1:] & (at[order][1:] == at[order][:-1]) & (doc[string][order][1:] == doc[string][order][:-1])
        late = np.sort((order[~first & ~same]))
        string, offset = string[late], offset[late]
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        new = np.ones(len(order), bool)
        new[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
        new = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[string[new]]), pa.array(whole["start"].to_numpy()[string[new]] + offset[new]),
             pa.array(np.diff(new, append=len(string)))], names=["row", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
            for b, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if e > b and bucket[b] != now:
                    if held:
                        yield from spans(held)
                    now, held = bucket[b], []
                held.append(batch.slice(b, e - b))
        if held:
            yield from spans(held)
    return run


def covered_windows(rows: DataFrame, length: int, n_bits: int = BITMAP_BITS, hot_runs: int = HOT_RUNS,
                    max_hot: int = MAX_HOT, bucket: int = BUCKET) -> DataFrame:
    """(row, start, n): n windows from byte ``start`` of row ``row`` on that also start earlier. ``rows`` has id, row
    and text; the order is that of (id, row)."""
    bitmap, hottest, total = repeated_keys(rows.select("text"), length, n_bits, hot_runs, max_hot)
    context = rows.sparkSession.sparkContext
    marks, hot = context.broadcast(bitmap), context.broadcast(hottest)
    buckets = max(8, total * (length + 40) // bucket)
    strings = rows.mapInArrow(_strings(length, marks, hot, n_bits, buckets), STRING)
    spans = (strings.repartition(min(buckets, 8192), "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_cover(length), SPAN))
    spans = saved(spans, "passage-spans")
    marks.destroy()
    hot.destroy()
    return spans


def _without(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 16 * SLICE):
                raw, offs = text_bytes(part.column("text"))
                data, out, kept = raw.tobytes(), [], []
                for i, spans in enumerate(part.column("spans").to_pylist()):
                    b, e, own, rest, at = int(offs[i]), int(offs[i + 1]), [], [], 0
                    for x in sorted((s["start"], s["start"] + s["n"] + length - 1) for s in spans or ()):
                        if own and x[0] <= own[-1][1]:
                            own[-1][1] = max(own[-1][1], x[1])
                        else:
                            own.append(list(x))
                    for begin, end in own:
                        rest.append(data[b + at:b + begin])
                        at = end
                    rest.append(data[b + at:e])
                    out.append([{"begin": x, "end": y} for x, y in own])
                    kept.append(b"".join(rest))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(offs)),
                     pa.array(out, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   **sizes: int) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` of its text in UTF-8, ``spans`` (begin and end of each maximal run of
    bytes that go) and ``kept`` (the other bytes; not always UTF-8, as a cut may fall inside a character).

    A byte goes if it lies in a string of ``length`` bytes (more than 24) within its text that also starts earlier: in a
    row with a smaller id, or before it in the same row. Ids are integers; a null id comes after all others, and rows
    that share an id (or have none) are in the order of the table, so of wholly repeated rows one stays. Nulls count as
    empty; texts shorter than ``length`` stay as they are. Other columns of ``docs``, whatever their names, are not
    read. An empty table gives an empty result. A text of any length is one row in one task. ``sizes``: see
    ``covered_windows``.
    """
    if length <= SEED:
        raise ValueError(f"length must be over {SEED}")
    last = (1 << 63) - 1
    rows = docs.select(F.col(id_col).alias("own_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("id"),
                       text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = saved(rows, "passage-docs")
    spans = covered_windows(rows.select("id", "row", "text"), length, **sizes)
    free_shuffles(rows.sparkSession)
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = rows.select("row", F.col("own_id").alias("id"), "text").join(spans.hint("shuffle_hash"), "row", "left")
    id_type = docs.schema[id_col].dataType.simpleString()
    out = joined.select("id", "text", "spans").mapInArrow(
        _without(length), f"id {id_type}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)


def digest(removed: DataFrame) -> DataFrame:
    """``remove_repeats``' rows with counts and the hash of what stays in place of spans and bytes."""
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return removed.select(*[c for c in removed.columns if c not in ("spans", "kept")], n_removed.alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
