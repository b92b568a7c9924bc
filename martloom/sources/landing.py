"""Readers: landing drops, partitioned tables, operational pulls, seeds, new files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from martloom import schemas
from martloom.session import own_session

# A task writes the files of so many days side by side; with more days it sorts its rows by day.
OPEN_DAYS = {"spark.sql.maxConcurrentOutputFileWriters": "2"}

GATEWAYS = ("vnpay", "momo", "card")
CORRUPT = "_corrupt_record"


def drop_path(root: str, source: str, date: str, suffix: str) -> str:
    """Files of one drop, plain or compressed."""
    return f"{root.rstrip('/')}/{source}/{date}/*.{{{suffix},{suffix}.gz}}"


def read_csv_landing(spark: SparkSession, root: str, source: str, date: str, schema: StructType) -> DataFrame:
    """One day's CSV drop. Rows that do not fit keep their text in ``_corrupt_record``."""
    return _keeping_corrupt(spark, schema).option("header", True).csv(drop_path(root, source, date, "csv"))


def _keeping_corrupt(spark: SparkSession, schema: StructType) -> DataFrameReader:
    return (spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))


def read_json_landing(spark: SparkSession, root: str, source: str, date: str, schema: StructType) -> DataFrame:
    """One day's JSON drop. Lines that do not parse keep their text in ``_corrupt_record``."""
    return _keeping_corrupt(spark, schema).json(drop_path(root, source, date, "json"))


def read_payments(spark: SparkSession, root: str, date: str) -> dict[str, DataFrame]:
    """One frame per gateway; their record layouts differ."""
    return {gateway: read_json_landing(spark, root, f"payments/{gateway}", date,
                                       schemas.RAW[f"payments_{gateway}"]) for gateway in GATEWAYS}


def read_partition(spark: SparkSession, root: str, table: str, date: str, column: str = "dt") -> DataFrame:
    """One day of a partitioned table; other days are pruned before any file is opened."""
    return spark.read.parquet(f"{root.rstrip('/')}/{table}").where(F.col(column) == F.lit(date).cast("date"))


def read_updated_day(spark: SparkSession, options: dict[str, str], date: dt.date,
                     column: str = "updated_at", fmt: str = "jdbc") -> DataFrame:
    """Rows changed on one day, pulled from a database (or any other reader format).

    The bounds compare the plain column, so the source evaluates them. For a large
    table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that the pull runs in parallel.
    """
    return updated_on(spark.read.format(fmt).options(**options).load(), date, column)


def updated_on(df: DataFrame, date: dt.date, column: str = "updated_at") -> DataFrame:
    kind = dict(df.dtypes)[column]
    start, end = (F.lit(d.isoformat()).cast(kind) for d in (date, date + dt.timedelta(days=1)))
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def new_files(spark: SparkSession, root: str, source: str, schema: StructType, fmt: str) -> DataFrame:
    """Stream of the landing files of one source, with the date found in the path."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    stamped = reader.load(f"{root.rstrip('/')}/{source}")
    date = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/", 1)
    return stamped.withColumn("landing_date", F.try_to_date(date))


def ingest_new_files(spark: SparkSession, root: str, source: str, schema: StructType, fmt: str,
                     checkpoint: str, out: str) -> StreamingQuery:
    """Append files not seen before. The checkpoint remembers what was taken.

    Rows of files whose path has no date are kept in the null partition of ``landing_date``, where
    ``undated`` finds them.
    """
    rows = new_files(own_session(spark, OPEN_DAYS), root, source, schema, fmt)
    return (rows.writeStream.format("parquet").partitionBy("landing_date").option("compression", "zstd")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))


def undated(spark: SparkSession, out: str) -> DataFrame:
    """Ingested rows that wait for somebody to tell their day."""
    return spark.read.parquet(out).where("landing_date IS NULL")
