"""Keeping a stream running, and carrying its state over to a changed query."""

from __future__ import annotations

import posixpath
import shutil
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.session import _file_system

LOGS = ("metadata", "offsets", "commits", "sources", "state")  # what a checkpoint consists of
COPY_BYTES = 8 << 20


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = 3, delay: float = 30.0,
                      pause: Callable[[float], None] = time.sleep) -> int:
    """Start a query and wait for its end; after a failure start it again, ``attempts`` times in all, ``delay`` seconds apart.

    ``start`` must use one checkpoint, from which each start goes on. Returns the number of restarts; the
    failure after the last one is raised. A query that is stopped, or has taken all there is, has ended.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            if restarts == attempts:
                raise
            restarts += 1
            pause(delay)


# --- savepoints -------------------------------------------------------------

def _files_below(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Paths below a folder, relative to it, with their sizes. Spark's own listing leaves out names that begin with ``_``."""
    files, handle = _file_system(spark, folder)
    if not files.exists(handle):
        return []
    whole = f"{files.makeQualified(handle).toString().rstrip('/')}/"
    found, out = files.listFiles(handle, True), []
    while found.hasNext():
        file = found.next()
        out.append((file.getPath().toString().removeprefix(whole), file.getLen()))
    return sorted((name, size) for name, size in out if name.split("/")[0] in LOGS)


def _opened(uri: str):
    """File system and path of a URI inside a task."""
    from pyarrow import fs
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{parts.path}")


def _copied(source: str, target: str) -> Callable[[Iterator[Row]], None]:
    def copy(rows: Iterator[Row]) -> None:
        for row in rows:
            here, there = _opened(f"{source}/{row.name}"), _opened(f"{target}/{row.name}")
            there[0].create_dir(posixpath.dirname(there[1]), recursive=True)
            with here[0].open_input_stream(here[1]) as data, there[0].open_output_stream(there[1]) as out:
                shutil.copyfileobj(data, out, COPY_BYTES)
    return copy


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest committed batch, -1 if there is none."""
    commits = [name.split("/")[1] for name, _ in _files_below(spark, checkpoint) if name.startswith("commits/")]
    return max((int(c) for c in commits if c.isdecimal()), default=-1)


def state_digest(spark: SparkSession, checkpoint: str, batch: int) -> DataFrame:
    """For every state store after a batch: rows, and one number that follows from all of them."""
    stores = (spark.read.format("state-metadata").load(checkpoint)
              .select("operatorId", "operatorName", "stateStoreName").distinct().orderBy("operatorId", "stateStoreName").collect())
    parts = [spark.createDataFrame([], "operator bigint, store string, n bigint, digest bigint")]
    for s in stores:
        state = (spark.read.format("statestore").option("batchId", batch).option("operatorId", s.operatorId)
                 .option("storeName", s.stateStoreName).load(checkpoint))
        parts.append(state.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.to_json(F.struct("key", "value")), "partition_id")).alias("digest"))
                     .select(F.lit(s.operatorId).cast("bigint").alias("operator"), F.lit(s.stateStoreName).alias("store"), "n", "digest"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def savepoint(spark: SparkSession, checkpoint: str, target: str) -> int:
    """Copy the checkpoint of a stopped query to a new folder and verify it; returns the batch it stands at.

    A changed query that keeps its sources, groupings and state may start from the copy, while the original still serves the
    old one. Its sink must not depend on earlier batches: a stored table takes it on at any batch, the log of a new file sink folder
    does not. Tasks copy the files; the driver knows their names only. The copy holds if every file has its size and every
    state store, read through Spark's state source, gives the same rows; otherwise ``RuntimeError`` is raised and the copy
    is not to be used. A checkpoint without a committed batch has nothing to carry over and is refused.
    """
    batch = last_batch(spark, checkpoint)
    if batch < 0:
        raise ValueError(f"no batch has been committed in {checkpoint}")
    files, handle = _file_system(spark, target)
    if files.exists(handle):
        raise ValueError(f"{target} exists already")
    names = _files_below(spark, checkpoint)
    tasks = min(len(names), 4 * spark.sparkContext.defaultParallelism)
    whole = [files.makeQualified(_file_system(spark, p)[1]).toString() for p in (checkpoint, target)]
    spark.createDataFrame(names, "name string, size bigint").repartition(tasks).foreachPartition(_copied(*whole))
    if _files_below(spark, target) != names:
        raise RuntimeError(f"files differ between {checkpoint} and {target}")
    old, new = (sorted(map(tuple, state_digest(spark, p, batch).collect())) for p in (checkpoint, target))
    if old != new:
        raise RuntimeError(f"state differs between {checkpoint} and {target}")
    return batch
