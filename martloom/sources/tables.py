"""Writers of plain folders: append, day overwrite, replace, records, backfill, compaction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.shaping import union_all
from martloom.session import PACKED, remove_path, workspace

PACKED_ROWS = 1_000_000
# The fast level: the usual one takes several times the CPU and saves a few percent.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _sized(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather the rows of a partition in few files. AQE splits a partition value that
    holds too much and joins small ones, so no task follows the size of one day."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True) -> None:
    """Where partition values are few, ``gather=False`` writes each task's rows as they are, without a shuffle."""
    (_sized(df, partition_by) if gather else df).write.mode("append").options(**PACKED).partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions present in the frame; running it again changes nothing."""
    (_sized(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    (_sized(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*partition_by).parquet(path))


def with_audit(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_partition_date": F.lit(date)})


def write_records(df: DataFrame, root: str, target: str, date: str, fmt: str = "json", packed: bool = False) -> str:
    """Records under ``{root}/{target}/{date}/`` as JSON lines, CSV or Parquet.

    ``packed`` compresses text files. Such a file is read by one task, so it holds at most ``PACKED_ROWS`` records.
    """
    path = f"{root.rstrip('/')}/{target}/{date}"
    options = {
        "csv": {"header": True, "timestampFormat": MICROS},
        "json": {"ignoreNullFields": False, "timestampFormat": MICROS},
    }
    writer = df.write.mode("append").format(fmt).options(**options.get(fmt, {}))
    if packed and fmt in options:
        writer = writer.options(**PACKED_TEXT, maxRecordsPerFile=PACKED_ROWS)
    writer.save(path)
    return path


def insert_if_absent(path: str, batch: DataFrame, key: str) -> None:
    """Append rows whose key the table does not hold yet."""
    held = batch.sparkSession.read.parquet(path).select(key)
    append_table(absent_rows(held, batch, key), path)


def absent_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    return batch.dropDuplicates([key]).join(target.select(key), key, "left_anti")


def ingest_counts(frames: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows per source and day, from one aggregate over narrow projections."""
    stamped = [df.select(F.lit(source).alias("source"), F.to_date(ts).alias("day"))
               for source, (df, ts) in frames.items()]
    return union_all(*stamped).groupBy("source", "day").agg(F.count("*").alias("row_count"))


def backfill(df: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str,
             day_column: str, start: dt.date, end: dt.date, partition: str) -> None:
    """Recompute a date range in one job and overwrite exactly its days.

    A source that has the partition column itself is pruned by it, so the other days' files stay closed.
    """
    days = df.where(F.to_date(day_column).between(F.lit(start), F.lit(end)))
    if partition in df.columns:
        days = days.where(F.col(partition).between(F.lit(start), F.lit(end)))
    overwrite_partitions(transform(days), path, [partition])


def compact(spark: SparkSession, path: str, partition: str, where: Column | None = None) -> None:
    """Rewrite the many small files of some partitions as few, in place; all partitions without ``where``.

    The condition names partition values, so only their files are read and replaced. The rows are
    staged first; the file size follows AQE's advisory size.
    """
    table = spark.read.parquet(path)
    staged = workspace(spark, "compact")
    append_table(table if where is None else table.where(where), staged, [partition])
    overwrite_partitions(spark.read.schema(table.schema).parquet(staged), path, [partition])
    remove_path(spark, staged)


def file_count(df: DataFrame) -> DataFrame:
    return df.select(F.input_file_name().alias("file")).distinct().agg(F.count("*").alias("files"))
