"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: split the skewed shuffle partition even when that costs a
    # later shuffle, because one task holding a third of the rows costs more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Rows of state are not counted: that takes a lookup before every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # A store's files are not laid out ahead: that takes 4 MB of disk for every store, whatever it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # Merge session fragments inside each map task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Tables of this library are written with it: their keys are long texts.
PACKED = {"compression": "zstd"}

# Folders that ``write_once`` made within ``scratch_removed``.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app: str = "martloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_STARTING = threading.RLock()


@contextmanager
def starting(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings for the streams started within: a stream keeps those of its session from when it starts."""
    with _STARTING:
        before = {key: spark.conf.get(key, None) for key in conf}
        try:
            for key, value in conf.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def own_session(spark: SparkSession, conf: Mapping[str, str]) -> SparkSession:
    """A session with the same settings and some of its own. The sink of a stream goes by those of the session that reads its source."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **conf}.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="martloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several later plans read, and return the table read back."""
    spark = df.sparkSession
    path = workspace(spark, label)
    if (made := _SCRATCH.get()) is not None:
        made.append(path)
    df.write.options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """What ``write_once`` writes within is removed at the end, so no frame that reads it may leave."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in made:
            remove_path(spark, path)


def side_by_side(*steps: Callable[[], object]) -> list:
    """Run steps that need nothing of each other at once, so that one's last tasks leave no cores idle. Results in order.

    All have ended when this returns or raises. At most four run at a time.
    """
    with ThreadPoolExecutor(min(4, len(steps))) as pool:
        return [done.result() for done in [pool.submit(copy_context().run, step) for step in steps]]


def _file_system(spark: SparkSession, path: str):
    """The file system that holds a path, as Spark sees it, and the path's handle."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), handle


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote and no later plan reads."""
    files, handle = _file_system(spark, path)
    files.delete(handle, True)
