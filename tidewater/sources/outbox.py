"""An outbox for requests to other systems: what was sent is on record, so a run that is repeated sends the rest.

Every request has a key derived from its row. Before it goes out, its *intent* is noted in the outbox folder; when the
answer is there, its *acknowledgement* with the status. Whoever runs the same requests again (a retried task, a repeated
job, a second look at a lazy result) finds the acknowledged ones answered and doesn't send them.

In a folder that can be appended to (local ones, mounted ones too) each sender notes both in a file of its own for a
shard, a line a request: the intent is its key, the acknowledgement ends the line. Each is handed over before the next
step, as a file that is closed would be. (A mounted store that can't append is to be named by its own URI.) Elsewhere
both are tiny files whose names say it all, created one by one, so they work on any store. As a tiny file fills a block
of a disk, the sender puts the acknowledgements of every PACK requests into one file (*pack*) and only then deletes the
tiny ones. A shard's log is what its folder holds in either form.

A request with an intent and no acknowledgement is in doubt: its sender died in between. ``on_doubt="send"`` sends it
again, with its key, by which the receiver can tell a repetition; ``on_doubt="hold"`` reports it and leaves it to
``resolve``. Two attempts must not run at once: keep ``spark.speculation`` off for the sending job.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 256
#: Acknowledged requests of a shard that are kept as tiny files until they are packed.
PACK = 1000
PACKED = pa.schema([("request_key", pa.string()), ("status", pa.int32()), ("attempts", pa.int32()),
                    ("at", pa.int64())])  # microseconds
KEY, SHARD = "request_key", "_tw_shard"
#: In a sender's own file: marks a line that takes back an intent; digits of the time that ends an acknowledgement, by
#: which one that broke off is told.
VOID, AT = "void", 16
STATUS = [T.StructField("status", T.IntegerType()), T.StructField("ok", T.BooleanType()),
          T.StructField("attempts", T.IntegerType()), T.StructField("in_doubt", T.BooleanType())]


def request_key(*columns: str) -> Column:
    """The same for equal values of the columns, nulls included, in every run."""
    return F.sha2(F.to_json(F.array(*[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"}), 256)


class Log:
    """The log of one shard, read when the first of its requests comes. Of several acknowledgements of a key one that
    worked counts, else the latest."""

    def __init__(self, folder: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.own = f"{uuid.uuid4().hex}.log" if isinstance(self.fs, pafs.LocalFileSystem) else None  # made when needed
        self.out = None  # the own file, once it is open
        self.begun: str | None = None  # the key in the last line of the own file, while that isn't ended
        self.intents, self.acks = set(), {}
        self.lines: dict[str, set[str]] = {}  # files that hold an intent of a key and no end of its line
        self.tiny: dict[str, list[str]] = {}  # files of a key
        self.loose: list[tuple] = []  # acknowledgements that are not packed
        known, void = [], set()
        for f in self.fs.get_file_info(pafs.FileSelector(self.folder)):
            if f.base_name.startswith("_"):  # a pack that was not finished
                continue
            key, kind, *rest = f.base_name.split(".")
            if kind == "parquet":
                with self.fs.open_input_file(f.path) as own:
                    known += zip(*(_values(c) for c in pq.read_table(own, schema=PACKED).columns))
                continue
            if kind == "log":
                with self.fs.open_input_file(f.path) as own:
                    for line in own.read().decode().split("\n"):
                        key, *rest = line.split(" ")
                        if len(rest) == 3 and len(rest[2]) == AT:
                            known.append((key, None if rest[0] == "none" else int(rest[0]), int(rest[1]), int(rest[2])))
                        elif rest and rest[0] == VOID:
                            void.add((key, rest[-1]))
                        elif rest:
                            self.lines.setdefault(key, set()).add(f.base_name)
                continue
            self.tiny.setdefault(key, []).append(f.base_name)
            if kind == "intent":
                self.intents.add(key)
            elif kind == "ack":
                self.loose.append((key, None if rest[0] == "none" else int(rest[0]), int(rest[1]), f.mtime_ns // 1000))
        for key, name in void:
            self.lines.get(key, set()).discard(name)
        self.intents |= {key for key, names in self.lines.items() if names}
        for key, status, attempts, _ in sorted(known + self.loose, key=lambda x: (_fine(x[1]), x[3])):
            self.acks[key] = (status, attempts)

    def _note(self, key: str, name: str) -> None:
        with self.fs.open_output_stream(f"{self.folder}/{name}") as out:
            out.write(b".")  # Spark's file scan leaves out files of no length
        self.tiny.setdefault(key, []).append(name)

    def _line(self, key: str) -> str:
        return ("\n" if self.begun else "") + f"{key} "

    def _append(self, text: str) -> None:
        if self.out is None:
            self.out = open(f"{self.folder}/{self.own}", "ab", buffering=0)
        data = text.encode()
        while data:
            data = data[self.out.write(data):]
        os.close(os.dup(self.out.fileno()))  # a mounted folder sends what was written when any descriptor is closed

    def intend(self, key: str) -> None:
        if key not in self.intents and key not in self.acks:
            if self.own:
                self._append(self._line(key))
                self.begun = key
                self.lines.setdefault(key, set()).add(self.own)
            else:
                self._note(key, f"{key}.intent")
            self.intents.add(key)

    def acknowledge(self, key: str, status: int | None, attempts: int) -> None:
        word, at = "none" if status is None else status, time.time_ns() // 1000
        if self.own:
            self._append(f"{'' if key == self.begun else self._line(key)}{word} {attempts} {at}\n")
            self.begun = None
            self.lines.pop(key, None)
        else:
            self._note(key, f"{key}.ack.{word}.{attempts}")
            self.loose.append((key, status, attempts, at))
        self.acks[key] = (status, attempts)

    def void(self, key: str) -> None:
        """What is in doubt counts as never begun."""
        for name in self.lines.pop(key, ()):
            self._append(f"{self._line(key)}{VOID} {name}\n")
            self.begun = None
        if f"{key}.intent" in self.tiny.get(key, ()):
            self.fs.delete_file(f"{self.folder}/{key}.intent")
            self.tiny[key].remove(f"{key}.intent")
        self.intents.discard(key)

    def close(self) -> None:
        self.pack()
        if self.out:
            self.out.close()

    def pack(self, least: int = 1) -> None:
        """Put the loose acknowledgements into one file, if there are ``least``; then delete their tiny files. Should the
        sender die in between, both are there and say the same. What is in doubt stays."""
        if len(self.loose) < least:
            return
        name = f"{uuid.uuid4().hex}.parquet"
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.loose), PACKED)], schema=PACKED)
        with self.fs.open_output_stream(f"{self.folder}/_{name}") as out:
            pq.write_table(table, out, compression="zstd")
        self.fs.move(f"{self.folder}/_{name}", f"{self.folder}/{name}")
        for key in dict.fromkeys(x[0] for x in self.loose):
            for own in dict.fromkeys(self.tiny.pop(key, [])):
                self.fs.delete_file(f"{self.folder}/{own}")
        self.loose = []


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """As ``to_pylist``, which makes a scalar of each value first."""
    whole = pa.types.is_integer(column.type) and not column.null_count
    return column.to_numpy(zero_copy_only=False).tolist() if whole or pa.types.is_string(column.type) else column.to_pylist()


def _folder(outbox: str, shard: int) -> str:
    return f"{outbox.rstrip('/')}/shard={shard}"


def _fine(status: int | None) -> bool:
    return status is not None and 200 <= status < 300


def _tried(sender: Callable[[dict], int], rec: dict, tries: int, backoff_s: float) -> tuple[int | None, int]:
    status, n = None, 0
    for n in range(1, tries + 1):
        try:
            status = int(sender(rec | {"attempt": n}))
        except Exception:  # noqa: BLE001 - transport errors count as a failed try
            status = None
        if _fine(status):
            break
        if backoff_s and n < tries:
            time.sleep(backoff_s * (2 ** (n - 1)))
    return status, n


def send(requests: DataFrame, id_col: str, sender: Callable[[dict], int], outbox: str | None = None, tries: int = 3,
         backoff_s: float = 0.0, on_doubt: str = "send", retry_failed: bool = False) -> DataFrame:
    """One status row per request: its columns, ``request_key``, ``status``, ``ok``, ``attempts`` and ``in_doubt``.

    A record's requests go in the order of ``step``; once one has not succeeded, those behind it are not sent (status
    null, no attempts). A request is tried up to ``tries`` times; the sender gets its columns, ``request_key`` and
    ``attempt``. An event without an id and a request without a record id are not sent. Requests that are equal in all
    columns share a key and go out once. With ``outbox`` (a folder that the executors reach, as a path or URI) sends are
    on record; ``retry_failed`` tries again what was acknowledged as failed. A record's requests are in one task; a shard
    holds the records that hash to it; its log is a file of each run that sent some of them, or where files can't be
    appended to, at most 2 * PACK tiny files and its packs."""
    if on_doubt not in ("send", "hold"):
        raise ValueError("on_doubt is send or hold")
    columns = requests.columns
    schema = T.StructType([*requests.schema.fields, T.StructField(KEY, T.StringType()), *STATUS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocked, shard, log, acks, done = None, False, None, None, {}, {}
        for b in batches:
            values = {c: _values(b.column(c)) for c in (*columns, KEY)}
            kinds, events = (values.get(c, [None] * len(b)) for c in ("kind", "event_id"))
            out = []
            for i, (own, record, key) in enumerate(zip(_values(b.column(SHARD)), values[id_col], values[KEY])):
                if record != current:
                    current, blocked = record, False
                    if done:
                        done = {}
                if outbox and own != shard:
                    if log:
                        log.close()
                    shard, log = own, Log(_folder(outbox, own))
                    acks = log.acks
                ack = acks.get(key)
                if ack and (not retry_failed or _fine(ack[0])):
                    found = (*ack, False)
                elif key in done:
                    found = done[key]
                elif blocked or record is None or (kinds[i] == "event" and events[i] is None):
                    found = (None, 0, False)
                elif log and on_doubt == "hold" and not ack and key in log.intents:
                    found = (None, 0, True)
                else:
                    if log:
                        log.intend(key)
                    rec = {c: v[i] for c, v in values.items()}
                    found = (*_tried(sender, rec, tries, backoff_s), False)
                    if log:
                        log.acknowledge(key, *found[:2])
                        log.pack(PACK)
                    done[key] = found
                blocked = blocked or not _fine(found[0])
                out.append(found)
            status, attempts, in_doubt = zip(*out) if out else ((), (), ())
            own = [pa.array(status, pa.int32()), pa.array([_fine(x) for x in status], pa.bool_()),
                   pa.array(attempts, pa.int32()), pa.array(in_doubt, pa.bool_())]
            names = [*values, *(f.name for f in STATUS)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in values), *own], names=names)
        if log:
            log.close()

    sharded = requests.withColumn(SHARD, F.pmod(F.xxhash64(id_col), F.lit(SHARDS)).cast("int"))
    # as many tasks as the session has for a shuffle, not as few as the bytes need: they wait for answers and files; the
    # shards are dealt in turn, as by hash some tasks would get several times as many as others
    ordered = sharded.repartitionById(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(SHARD)) \
        .sortWithinPartitions(SHARD, id_col, "step")
    return ordered.select(*columns, request_key(*columns).alias(KEY), SHARD).mapInArrow(run, schema)  # keys don't compress


def statuses(spark: SparkSession, outbox: str) -> DataFrame:
    """(request_key, status, attempts, in_doubt) of all that the outbox has on record, the latest acknowledgement first
    of all; read from the senders' own files, the packs and the names of the tiny files, in tasks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{intent,ack.*}").load(f"{outbox.rstrip('/')}/shard=*") \
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "modificationTime")
    part = F.split("name", r"\.")
    ack = F.get(part, F.lit(1)) == "ack"
    rows = files.select(F.get(part, F.lit(0)).alias(KEY), ack.alias("ack"), F.unix_micros("modificationTime").alias("at"),
                        F.when(ack, F.expr("try_cast(get(split(name, '[.]'), 2) as int)")).alias("status"),
                        F.when(ack, F.get(part, F.lit(3)).cast("int")).alias("attempts"),
                        F.when(~ack, F.col("name")).alias("begun"))
    lines = spark.read.option("pathGlobFilter", "*.log").text(f"{outbox.rstrip('/')}/shard=*") \
        .select(F.split("value", " ").alias("part"), F.col("_metadata.file_name").alias("name")).where(F.size("part") > 1)
    part = [F.get("part", F.lit(i)) for i in range(4)]
    ack = (F.size("part") == 4) & (F.length(part[3]) == AT)
    void = part[1] == VOID
    rows = rows.unionByName(lines.select(
        part[0].alias(KEY), ack.alias("ack"), F.when(ack, part[3].cast("bigint")).alias("at"),
        F.when(ack, part[1].try_cast("int")).alias("status"), F.when(ack, part[2].cast("int")).alias("attempts"),
        F.when(~ack & ~void, F.col("name")).alias("begun"), F.when(void, F.get("part", F.lit(2))).alias("void")),
        allowMissingColumns=True)
    packs = spark.read.schema(f"{KEY} string, status int, attempts int, at bigint") \
        .option("pathGlobFilter", "*.parquet").parquet(f"{outbox.rstrip('/')}/shard=*")
    rows = rows.unionByName(packs.withColumn("ack", F.lit(True)), allowMissingColumns=True)
    fine = F.coalesce(F.col("status").between(200, 299), F.lit(False))  # once it has worked, it has worked
    last = rows.groupBy(KEY).agg(F.max(F.struct("ack", fine.alias("fine"), "at", "status", "attempts")).alias("x"),
                                 F.array_except(F.collect_set("begun"), F.collect_set("void")).alias("begun"))
    return last.where(F.col("x.ack") | (F.size("begun") > 0)) \
        .select(KEY, "x.status", "x.attempts", (~F.col("x.ack")).alias("in_doubt"))


def resolve(spark: SparkSession, outbox: str, answers: DataFrame) -> None:
    """Settle requests in doubt: ``answers`` has request_key, id (the record's) and the status that the receiver knows,
    null if it never got the request, which then is sent by the next run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, log = None, None
        for b in batches:
            for r in b.to_pylist():
                if r[SHARD] != shard:
                    shard, log = r[SHARD], Log(_folder(outbox, r[SHARD]))
                if r["status"] is None:
                    if r[KEY] in log.intents and r[KEY] not in log.acks:
                        log.void(r[KEY])
                elif r[KEY] not in log.acks:
                    log.acknowledge(r[KEY], r["status"], 0)
            yield b.select([KEY])

    own = answers.select(KEY, F.col("status").cast("int").alias("status"),
                         F.pmod(F.xxhash64("id"), F.lit(SHARDS)).cast("int").alias(SHARD))
    own.repartition(SHARD).sortWithinPartitions(SHARD).mapInArrow(run, f"{KEY} string") \
        .write.format("noop").mode("overwrite").save()
