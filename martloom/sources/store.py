"""Tables whose content is named by a log, so that a change of any number of tables shows at once.

Rows are written to a folder of their own, ``{root}/{table}/run=<id>``, which no reader looks at. A commit appends one
line to the log under ``{root}/log``: for every changed table its run and the partitions it holds from now on, with
high-water marks and the writer's batch beside them. That line is one file, put in place by one rename, so a reader
sees all of a commit or nothing of it, wherever its writer dies; nothing that is visible is ever overwritten. Readers turn
the log into a filter on the run and the partition column, which prunes folders before any file is opened.

One writer at a time; readers need no lock. The log and the filters follow the number of partitions and commits, not rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martloom.operators.dedup import latest_per_key
from martloom.session import PACKED, remove_path

RUN = "run"
WHOLE = "*"  # the one partition of a table without a partition column
LOG = ("version bigint, at timestamp, writer string, batch bigint, marks map<string, string>, changes array<struct<"
       "name: string, partition: string, run: string, mode: string, held: array<string>, dropped: array<string>, layout: string>>")


def among(column: str | Column, values: Iterable) -> Column:
    """Is the column's text one of the values? A null value stands for null."""
    column = F.col(column) if isinstance(column, str) else column
    texts = [None if v is None else str(v) for v in values]
    plain = [v for v in texts if v is not None]
    found = column.cast("string").isin(plain) if plain else F.lit(False)
    return F.coalesce(found, F.lit(False)) | (column.isNull() if None in texts else F.lit(False))


def values_of(df: DataFrame, column: str) -> set:
    """Distinct texts of a partition column, null among them: as many as there are partitions."""
    return {r[0] for r in df.select(F.col(column).cast("string")).distinct().toLocalIterator()}


@dataclass(frozen=True)
class Change:
    """What a commit does to one table: ``replace`` everything, ``rewrite`` some partitions, or ``append`` to them."""

    name: str
    partition: str | None
    run: str
    mode: str
    held: tuple
    dropped: tuple
    layout: str

    @property
    def touched(self) -> set:
        return {*self.held, *self.dropped}


class _Contents:
    """The log folded up: for each table its columns and the runs of each partition value."""

    def __init__(self):
        self.version = 0
        self.layouts: dict[str, tuple[StructType, str | None]] = {}
        self.runs: dict[str, dict] = defaultdict(dict)
        self.marks: dict[str, str] = {}
        self.batches: dict[str, int] = {}

    def apply(self, change: Change) -> None:
        self.layouts[change.name] = (StructType.fromJson(json.loads(change.layout)), change.partition)
        held = {} if change.mode == "replace" else dict(self.runs[change.name])
        for value in change.dropped:
            held.pop(value, None)
        for value in change.held:
            held[value] = (*held.get(value, ()), change.run) if change.mode == "append" else (change.run,)
        self.runs[change.name] = held

    def copy(self) -> _Contents:
        other = _Contents()
        other.version, other.layouts, other.marks, other.batches = self.version, dict(self.layouts), dict(self.marks), dict(self.batches)
        other.runs = defaultdict(dict, {k: dict(v) for k, v in self.runs.items()})
        return other


class TableStore:
    """The tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> list:
        try:
            lines = self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(lines.collect(), key=lambda r: r.version)

    def contents(self, version: int | None = None) -> _Contents:
        """What the log says, up to a version."""
        out = _Contents()
        for line in self._log():
            if version is not None and line.version > version:
                break
            out.version = line.version
            out.marks.update(line.marks or {})
            if line.writer is not None:
                out.batches[line.writer] = line.batch
            for c in line.changes:
                out.apply(Change(c.name, c.partition, c.run, c.mode, tuple(c.held), tuple(c.dropped), c.layout))
        return out

    def history(self) -> DataFrame:
        """``version, at, writer, batch, changes``, as committed."""
        return self.spark.createDataFrame(self._log(), LOG)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of its newest version, or an older one that has not been expired."""
        return self.frame(table, self.contents(version))

    def exists(self, table: str) -> bool:
        return table in self.contents().layouts

    def partitions(self, table: str) -> set:
        return set(self.contents().runs.get(table, ()))

    def frame(self, table: str, contents: _Contents) -> DataFrame:
        layout, partition = contents.layouts[table]
        held = contents.runs[table]
        kept: dict[str, set] = defaultdict(set)
        for value, runs in held.items():
            for run in runs:
                kept[run].add(value)
        rows = self.spark.read.schema(StructType([*layout.fields, StructField(RUN, StringType())])).parquet(f"{self.root}/{table}")
        current = [(F.col(RUN) == run) & (among(partition, values) if partition else F.lit(True)) for run, values in sorted(kept.items())]
        return rows.where(reduce(Column.__or__, current, F.lit(False))).select(*layout.names)

    def begin(self) -> Transaction:
        return Transaction(self)

    def put(self, table: str, rows: DataFrame, partition: str | None = None) -> int:
        """Replace one table."""
        work = self.begin()
        work.replace(table, rows, partition)
        return work.commit()

    def merge(self, table: str, updates: DataFrame, key: Sequence[str], version: str, partition: str | None,
              tie_break: Sequence[Column | str], writer: str | None = None, batch: int | None = None, moves: bool = True) -> int:
        """Upsert into one table; a batch that its writer has committed before changes nothing."""
        work = self.begin()
        if work.seen(writer, batch):
            return work.contents.version
        work.merge(table, updates, key, version, partition, tie_break, moves)
        return work.commit(writer=writer, batch=batch)

    def retain(self, table: str, keep_from: dt.date) -> int:
        """Expire partitions of days before ``keep_from``, by the log alone: no file is opened or changed.

        A table that the log does not know is refused, and so is an expiry that would leave nothing of it.
        """
        work = self.begin()
        values = work.contents.runs.get(table)
        if not values:
            raise ValueError(f"no partitions of {table} are known; nothing is expired")
        expired = {v for v in values if v is not None and dt.date.fromisoformat(v) < keep_from}
        if expired == set(values):
            raise ValueError(f"all partitions of {table} lie before {keep_from}; nothing is expired")
        work.drop(table, expired)
        return work.commit() if expired else work.contents.version

    def unused(self, keep: int = 1) -> list[str]:
        """Run folders that none of the last ``keep`` versions names, for the folder's own clean-up."""
        newest = self.contents().version
        named = {(t, run) for v in range(max(newest - keep + 1, 1), newest + 1)
                 for t, held in self.contents(v).runs.items() for runs in held.values() for run in runs}
        every = {(c.name, c.run) for line in self._log() for c in line.changes if c.run}
        return sorted(f"{self.root}/{t}/{RUN}={run}" for t, run in every - named)

    def expire(self, keep: int = 1) -> list[str]:
        """Remove the folders that ``unused`` names; older versions cannot be read any more."""
        gone = self.unused(keep)
        for path in gone:
            remove_path(self.spark, path)
        return gone


class Transaction:
    """Changes that are written aside and read by later steps of the same work, until one commit shows them all."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark
        self.contents = store.contents()
        self.before = self.contents.copy()
        self.changes: list[Change] = []

    def exists(self, table: str) -> bool:
        return table in self.contents.layouts

    def read(self, table: str) -> DataFrame:
        """The table with this transaction's changes."""
        return self.store.frame(table, self.contents)

    def seen(self, writer: str | None, batch: int | None) -> bool:
        """Has the writer committed this batch before?"""
        return writer is not None and self.before.batches.get(writer, -1) >= batch

    def read_before(self, table: str) -> DataFrame:
        return self.store.frame(table, self.before)

    def _stage(self, table: str, rows: DataFrame, partition: str | None, mode: str, touched: Iterable = (), gather: bool = True) -> Change:
        run = uuid.uuid4().hex
        path = f"{self.store.root}/{table}/{RUN}={run}"
        by = [partition] if partition else []
        sized = rows.hint("rebalance", *[F.col(c) for c in by]) if by and gather else rows
        sized.write.options(**PACKED).partitionBy(*by).parquet(path)
        # As the folders name them: an empty text becomes null there.
        written = self.spark.read.schema(rows.schema).parquet(path)
        held = values_of(written, partition) if partition else {WHOLE}
        change = Change(table, partition, run, mode, tuple(held), tuple(set(touched) - held), rows.schema.json())
        self.changes.append(change)
        self.contents.apply(change)
        return change

    def replace(self, table: str, rows: DataFrame, partition: str | None = None, gather: bool = True) -> Change:
        """``rows`` are all there is. Where partitions are few, ``gather=False`` writes each task's rows as they are, without a shuffle."""
        return self._stage(table, rows, partition, "replace", gather=gather)

    def append(self, table: str, rows: DataFrame, partition: str | None = None) -> Change:
        return self._stage(table, rows, partition, "append")

    def rewrite(self, table: str, rows: DataFrame, partition: str, touched: Iterable, gather: bool = True) -> Change:
        """``rows`` are all there is of the touched partitions from now on; those without rows go."""
        return self._stage(table, rows, partition, "rewrite", touched, gather)

    def drop(self, table: str, values: Iterable) -> None:
        layout, partition = self.contents.layouts[table]
        change = Change(table, partition, None, "rewrite", (), tuple(values), layout.json())
        self.changes.append(change)
        self.contents.apply(change)

    def regroup(self, table: str, updates: DataFrame, key: Sequence[str], partition: str | None,
                fold: Callable[[DataFrame], DataFrame], moves: bool = True, gather: bool = True) -> Change:
        """Fold updates into the rows of their keys.

        Only partitions that an update belongs to or that hold a row of an updated key are read and rewritten. The latter
        are found from the key and partition columns alone; where a key's partition never changes (``moves=False``), or the updates
        belong to every partition there is, they need not be looked for. ``fold`` gets the old rows of those partitions and the updates and must leave other keys as they are.
        """
        if not self.exists(table):
            return self.replace(table, fold(updates), partition, gather)
        old = self.read(table)
        updates = updates.select(*old.columns)
        if partition is None:
            return self.replace(table, fold(old.unionByName(updates)))
        same = reduce(Column.__and__, [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in key])
        touched = values_of(updates.select(F.col(partition).cast(old.schema[partition].dataType)), partition)
        if moves and not touched >= set(self.contents.runs[table]):
            keys = updates.select(*key).distinct()
            holding = old.select(*dict.fromkeys([*key, partition])).alias("t").join(keys.alias("u"), same, "left_semi")
            touched |= values_of(holding, partition)
        return self.rewrite(table, fold(old.where(among(partition, touched)).unionByName(updates)), partition, touched, gather)

    def merge(self, table: str, updates: DataFrame, key: Sequence[str], version: str, partition: str | None,
              tie_break: Sequence[Column | str], moves: bool = True) -> Change:
        """Keep the newest version of every key, null keys included."""
        return self.regroup(table, updates, key, partition, lambda rows: latest_per_key(rows, list(key), version, tie_break), moves)

    def commit(self, marks: Mapping[str, str] | None = None, writer: str | None = None, batch: int | None = None) -> int:
        """Show all changes at once. Returns the new version."""
        version = self.before.version + 1
        if self.store.contents().version != self.before.version:
            raise RuntimeError("another writer has committed since this transaction began")
        line = (version, dt.datetime.now(dt.timezone.utc), writer, batch, dict(marks or {}),
                [(c.name, c.partition, c.run, c.mode, list(c.held), list(c.dropped), c.layout) for c in self.changes])
        self.spark.createDataFrame([line], LOG).coalesce(1).write.mode("append").json(f"{self.store.root}/log")
        return version
