"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of a query are deleted when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library counts on.

    Shuffle partitions are left to the cluster (AQE coalesces them); state of
    streaming queries lives in RocksDB so it may outgrow the heap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        STATE_STORE: ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without: it gets a temporary folder. On a
    cluster a machine-local folder would lose data, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="tidewatch-")
    context.setCheckpointDir(base)
    return context.getCheckpointDir()


_scratch: list[str] = []
_pinned: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete what this process wrote to scratch paths.

    Frames that were pinned cannot be read any more afterwards.
    """
    while _scratch:
        _delete(spark, _scratch.pop())


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started meanwhile; those before come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def pin(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    The files are written by the executors and read back through the normal
    parquet reader, so a lost executor costs a re-read, not a re-computation.
    The shuffles behind ``df`` are gone afterwards.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    with settings(spark, {CLEANUP: "true"}):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _pinned[out] = path
    return out


def unpin(*pinned: DataFrame) -> None:
    """Delete what ``pin`` wrote for frames that nothing reads any more.

    What was computed from them must be pinned itself, or be thrown away.
    """
    for df in pinned:
        path = _pinned.pop(df)
        _delete(df.sparkSession, path)
        _scratch.remove(path)
