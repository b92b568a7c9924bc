"""Starting, draining and resuming streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.dedup import latest_per_key
from martloom.session import starting, workspace, write_once
from martloom.sources.store import TableStore

# For a stream that ends once it has taken everything: a state store is closed with its task instead of staying loaded, a join
# keeps its state in one store a partition, not four, and the stores of an executor share their buffers and cache, which
# otherwise are every store's own and outlive it.
_STATE = "spark.sql.streaming.stateStore"
STATE_OF_ONE_RUN = {f"{_STATE}.unloadOnCommit": "true", "spark.sql.streaming.join.stateFormatVersion": "3",
                    f"{_STATE}.rocksdb.boundedMemoryUsage": "true", f"{_STATE}.rocksdb.maxMemoryUsageMB": "300"}


def start(df: DataFrame, out: str, checkpoint: str, every: str | None = None,
          partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a parquet table. Without ``every``, take what is there and stop.

    Offsets, state and the sink log live in the checkpoint, so a restart with the same
    folder continues without loss or repetition.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (df.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start(out))


def drain(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available and return the table it wrote."""
    spark = df.sparkSession
    folder = workspace(spark, label)
    with starting(spark, STATE_OF_ONE_RUN):
        stream = start(df, f"{folder}/out", f"{folder}/checkpoint")
    stream.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def upsert(df: DataFrame, store: TableStore, table: str, checkpoint: str, key: Sequence[str], version: str,
           partition: str | None, tie_break: Sequence[Column | str]) -> StreamingQuery:
    """Keep the newest version per key in a stored table, batch by batch.

    The commit names the batch, so one that is replayed after a failure is found in the log and changes nothing;
    readers see a batch whole or not at all. ``tie_break`` orders rows of one key and version.
    """
    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(upsert_batch(store.root, table, checkpoint, key, version, partition, tie_break)).start())


def upsert_batch(root: str, table: str, writer: str, key: Sequence[str], version: str, partition: str | None,
                 tie_break: Sequence[Column | str]) -> Callable[[DataFrame, int], None]:
    """What ``upsert`` does with each batch. ``writer`` names the stream in the log."""
    def write(rows: DataFrame, batch: int) -> None:
        store = TableStore(rows.sparkSession, root)
        # The merge reads the batch several times. Its newest rows are all that can count.
        taken = write_once(latest_per_key(rows, key, version, tie_break), "batch")
        store.merge(table, taken, key, version, partition, tie_break, writer, batch)

    return write
