"""Message encoding for Kafka topics. The connector jar comes with the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from martloom.sources.tables import MICROS

KEY_COLUMNS = ("order_id", "event_id", "reading_id")


def kafka_encode(df: DataFrame, key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """(key, value): first non-empty id column as key, the whole row as JSON."""
    ids = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in key_columns if c in df.columns]
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false", "timestampFormat": MICROS})
    return df.select(F.coalesce(*ids, F.lit(None).cast("string")).alias("key"), value.alias("value"))


def kafka_decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """JSON values to typed columns; fields that do not parse become null."""
    parsed = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    return messages.select(parsed.alias("_row")).select("_row.*")


def split_malformed(messages: DataFrame, body: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the rest with their text for the dead-letter table."""
    with_flag = StructType(list(schema.fields)).add("_corrupt_record", "string")
    parsed = F.from_json(F.col(body), with_flag, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = messages.withColumn("_row", parsed)
    bad = F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull() | (F.trim(body) == "")
    bad = F.coalesce(bad, F.lit(True))
    good_rows = rows.where(~bad).select("_row.*").drop("_corrupt_record")
    return good_rows, rows.where(bad).drop("_row")


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "latest").load())


def write_topic(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))
