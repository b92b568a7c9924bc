"""Streams that feed stored tables, each batch in one commit that names it: ingest with dead letters, late rows, change feeds.

A batch that is replayed after a failure is found in the log and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from martloom.session import write_once
from martloom.sources.landing import CORRUPT
from martloom.sources.store import TableStore, Transaction, among

DEAD = "dead_letters"


def each_batch(df: DataFrame, store: TableStore, checkpoint: str, step: Callable[[Transaction, DataFrame], dict | None],
               every: str | None = None) -> StreamingQuery:
    """Run ``step(transaction, rows)`` on every batch; what it stages, and the marks it returns, show in one commit."""
    root = store.root

    def write(rows: DataFrame, batch: int) -> None:
        work = TableStore(rows.sparkSession, root).begin()
        if not work.seen(checkpoint, batch):
            marks = step(work, rows)
            work.commit(marks, checkpoint, batch)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
            .foreachBatch(write).start())


# --- ingest without loss ----------------------------------------------------

def parsed_lines(lines: DataFrame, schema: StructType, fmt: str) -> DataFrame:
    """The fields of each line, or its text in ``_corrupt_record``. A CSV header line is no record.

    ``lines`` has ``value``, ``file`` and ``landing_date``. A record is one line: text with line breaks inside quotes is corrupt.
    """
    fields = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if fmt == "csv":
        lines = lines.where(F.col("value") != ",".join(schema.names))
        row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), options)
    else:
        row = F.from_json("value", fields, options)
    # An empty line and one that is no object give no row at all.
    parsed = lines.select("value", "file", "landing_date", row.alias("row"))
    empty = reduce(Column.__and__, [F.col(f"row.`{n}`").isNull() for n in schema.names])
    corrupt = F.coalesce(F.col(f"row.{CORRUPT}"), F.when(F.col("row").isNull() | empty, F.col("value")))
    return parsed.select(*[F.col(f"row.`{n}`").alias(n) for n in schema.names], "landing_date", "file", "value", corrupt.alias(CORRUPT))


def ingest_lines(spark: SparkSession, root: str, source: str, schema: StructType, fmt: str, store: TableStore,
                 checkpoint: str) -> StreamingQuery:
    """Append the records of new landing files to table ``source``, and lines that do not fit to ``dead_letters``.

    A dead letter keeps its source, file, day and whole line. Both tables change in one commit, so no line is lost
    or doubled by a batch that dies. Rows of files whose path has no date stand in the null partition.
    """
    found = spark.readStream.format("text").option("recursiveFileLookup", True).load(f"{root.rstrip('/')}/{source}")
    date = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/", 1)
    lines = found.select("value", F.col("_metadata.file_path").alias("file"), F.try_to_date(date).alias("landing_date"))

    def step(work: Transaction, rows: DataFrame) -> None:
        parsed = parsed_lines(rows, schema, fmt)
        good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "file", "value")
        bad = parsed.where(F.col(CORRUPT).isNotNull()).select(F.lit(source).alias("source"), "landing_date", "file", F.col("value").alias("line"))
        work.append(source, good, "landing_date")
        work.append(DEAD, bad, "landing_date")

    return each_batch(lines, store, checkpoint, step)


# --- late rows --------------------------------------------------------------

def late_table(table: str) -> str:
    return f"{table}_late"


def with_late_rows_aside(events: DataFrame, store: TableStore, table: str, checkpoint: str, ts: str, delay: str,
                         day: str) -> StreamingQuery:
    """Append rows to ``table``, those behind the watermark to its late table.

    The watermark is the newest time of all batches before, less ``delay``; it is stored with the commit that moves it. ``day`` is the
    partition column. Rows without a time are late, for nobody can tell where they belong.
    """
    mark = f"watermark:{table}"

    def step(work: Transaction, rows: DataFrame) -> dict:
        held = work.before.marks.get(mark)
        taken = write_once(rows, "batch")
        line = F.lit(held).cast("timestamp")
        late = F.col(ts).isNull() | F.coalesce(F.col(ts) < line, F.lit(False))
        work.append(table, taken.where(~late), day)
        work.append(late_table(table), taken.where(late), day)
        newest = F.max(F.col(ts).cast("timestamp")) - F.expr(f"INTERVAL {delay}")
        moved = taken.agg(F.greatest(line, newest).cast("string")).first()[0]
        return {} if moved is None else {mark: moved}

    return each_batch(events, store, checkpoint, step)


def take_late_rows(store: TableStore, table: str, day: str) -> int:
    """The daily correction: late rows move into the table, in one commit. Returns how many; a second run finds none."""
    work, name = store.begin(), late_table(table)
    days = {d for d in work.contents.runs[name] if d is not None}
    if not days:
        return 0
    seen = Observation()
    work.append(table, work.read(name).where(F.col(day).isNotNull()).observe(seen, F.count("*").alias("n")), day)
    work.drop(name, days)
    work.commit()
    return seen.get["n"]


# --- change feeds -----------------------------------------------------------

SEQ, DELETED, BUCKET = "_seq", "_deleted", "_bucket"


def change_rows(changes: DataFrame, key: str, seq: str, row: str = "after", op: str = "op", buckets: int = 64) -> DataFrame:
    """Envelopes as rows with their sequence; a deletion is a row that says so, its other fields null."""
    fields = [f for f in changes.schema[row].dataType.names if f != key]
    return changes.select(
        F.coalesce(F.col(f"{row}.{key}"), F.col(f"before.{key}")).alias(key), *[F.col(f"{row}.{f}").alias(f) for f in fields],
        F.col(seq).alias(SEQ), (F.col(op) == "d").alias(DELETED)).withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))


def apply_changes(store: TableStore, table: str, changes: DataFrame, key: str, seq: str, writer: str | None = None,
                  batch: int | None = None, **shape) -> int:
    """Apply change envelopes to a stored table; the newest sequence of a key counts, whatever comes first.

    Deletions stay as tombstones with their sequence, so an older change that comes late cannot bring a row back. Rows are
    kept by a hash of the key, and a batch rewrites the buckets of its keys alone.
    """
    rows = write_once(change_rows(changes, key, seq, **shape), "changes")
    return store.merge(table, rows, [key], SEQ, BUCKET, [F.desc(DELETED)], writer, batch, moves=False)


def live_rows(table: DataFrame) -> DataFrame:
    """What a changed table holds: no tombstones, no bookkeeping."""
    return table.where(~F.col(DELETED)).drop(SEQ, DELETED, BUCKET)


def forget_tombstones(store: TableStore, table: str, before: Column | int) -> int:
    """Drop tombstones older than a sequence no feed will go back behind."""
    work = store.begin()
    rows = work.read(table)
    old = rows.where(F.col(DELETED) & (F.col(SEQ) < before))
    buckets = {r[0] for r in old.select(F.col(BUCKET).cast("string")).distinct().toLocalIterator()}
    kept = rows.where(among(BUCKET, buckets)).where(~(F.col(DELETED) & (F.col(SEQ) < before)))
    work.rewrite(table, kept, BUCKET, buckets)
    return work.commit()
