"""A log of which stretches of time an output holds.

``Ranges`` is the set algebra: disjoint half-open stretches in order. ``Ledger`` is an append-only log of small JSON
records beside the data, each created exclusively, so the log has one order. A writer notes its *intent* (the stretches
it is about to replace) before it touches a file and *commits* what they hold when all is written. Replaying the log
gives what is covered, and what has to be written again: an intent without its commit has left its stretches torn, so
they count as uncovered, and what they had held before is owed.

The log is metadata: two records a run, folded into one snapshot every ``FOLD`` records.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.partitions import delete, file_names, read_text, write_text

FOLD = 64
DAY = timedelta(days=1)


class Ranges:
    """Disjoint half-open stretches ``[begin, end)`` of time, in order; those that touch are one."""

    def __init__(self, parts=()):
        self.parts: list[tuple[datetime, datetime]] = []
        for begin, end in sorted((b, e) for b, e in parts if b < e):
            if self.parts and begin <= self.parts[-1][1]:
                self.parts[-1] = (self.parts[-1][0], max(end, self.parts[-1][1]))
            else:
                self.parts.append((begin, end))

    def __or__(self, other: Ranges) -> Ranges:
        return Ranges(self.parts + other.parts)

    def __and__(self, other: Ranges) -> Ranges:
        out, i, j = [], 0, 0
        while i < len(self.parts) and j < len(other.parts):
            (b, e), (x, y) = self.parts[i], other.parts[j]
            out.append((max(b, x), min(e, y)))
            i, j = (i + 1, j) if e <= y else (i, j + 1)
        return Ranges(out)

    def __sub__(self, other: Ranges) -> Ranges:
        out, j = [], 0
        for begin, end in self.parts:
            while j and other.parts[j - 1][1] > begin:
                j -= 1
            while j < len(other.parts) and other.parts[j][0] < end:
                out.append((begin, other.parts[j][0]))
                begin = max(begin, other.parts[j][1])
                j += 1
            out.append((begin, end))
        return Ranges(out)

    def __bool__(self) -> bool:
        return bool(self.parts)

    def __eq__(self, other) -> bool:
        return isinstance(other, Ranges) and self.parts == other.parts

    def __repr__(self) -> str:
        return f"Ranges({self.parts})"

    def whole_days(self) -> Ranges:
        """Widened to the days that they touch."""
        return Ranges((_midnight(b), _midnight(e - timedelta(microseconds=1)) + DAY) for b, e in self.parts)

    def holds(self, ts: Column) -> Column:
        """Whether a time lies in them; a plain predicate, so it reaches the scan."""
        found = F.lit(False)
        for begin, end in self.parts:
            found = found | ((ts >= F.lit(begin.isoformat(" ")).cast("timestamp_ntz"))
                             & (ts < F.lit(end.isoformat(" ")).cast("timestamp_ntz")))
        return found


def _midnight(t: datetime) -> datetime:
    return datetime(t.year, t.month, t.day)


def as_time(t: str | datetime) -> datetime:
    return datetime.fromisoformat(t) if isinstance(t, str) else t


class Ledger:
    """The log of the output at ``path``, in a folder that readers of the output skip. One writer at a time: an open
    intent is taken for a dead job's."""

    FOLDER = "_coverage"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/{self.FOLDER}"

    def _records(self) -> list[tuple[int, dict]]:
        out = []
        for name in sorted(n for n in file_names(self.spark, self.path) or [] if n.endswith(".json")):
            try:
                out.append((int(name.split(".")[0]), json.loads(read_text(self.spark, f"{self.path}/{name}"))))
            except ValueError:  # its writer died within it: it says nothing
                out.append((int(name.split(".")[0]), {"kind": "torn"}))
        return out

    def _append(self, record: dict) -> int:
        """Write the next record; two writers can't create the same one."""
        place = max((n for n, _ in self._records()), default=0) + 1
        write_text(self.spark, f"{self.path}/{place:010d}.json", json.dumps(record), overwrite=False)
        return place

    def state(self) -> tuple[Ranges, Ranges]:
        """What is covered, and what torn stretches had covered before."""
        covered, owed, open_ = Ranges(), Ranges(), {}
        for _, r in self._records():
            held = Ranges((as_time(b), as_time(e)) for b, e in r.get("ranges", ()))
            if r["kind"] == "snapshot":
                covered = held
                owed, open_ = Ranges((as_time(b), as_time(e)) for b, e in r["owed"]), {}
            elif r["kind"] == "intent":
                owed, covered = owed | (covered & held), covered - held
                open_[r["run"]] = held
            elif r["kind"] == "commit" and r["run"] in open_:
                touched = open_.pop(r["run"])
                covered, owed = covered | held, owed - touched
        return covered, owed

    def intend(self, touched: Ranges) -> str:
        run = uuid.uuid4().hex
        self._append({"kind": "intent", "run": run, "ranges": _texts(touched)})
        return run

    def commit(self, run: str, held: Ranges) -> None:
        place = self._append({"kind": "commit", "run": run, "ranges": _texts(held)})
        if place % FOLD == 0:
            self.fold()

    def fold(self) -> None:
        """One record in place of all so far. Dying within leaves the old ones, which the snapshot overrules."""
        covered, owed = self.state()
        place = self._append({"kind": "snapshot", "ranges": _texts(covered), "owed": _texts(owed)})
        for n, _ in self._records():
            if n < place:
                delete(self.spark, f"{self.path}/{n:010d}.json")

    def frame(self) -> DataFrame:
        """(begin, end): what is covered, a row for each stretch."""
        return self.spark.createDataFrame(self.state()[0].parts, "begin timestamp_ntz, end timestamp_ntz")


def _texts(ranges: Ranges) -> list[list[str]]:
    return [[b.isoformat(), e.isoformat()] for b, e in ranges.parts]
