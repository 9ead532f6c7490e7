"""Session settings the library relies on, and the shared folder it writes to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hours and dates are read in the session zone; the contract is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: For state that outgrows the heap: kept on disk, with a bound to what an executor holds of it
#: outside the heap. Keys are not counted, as each would be read once more to be written or
#: forgotten: ``numRowsTotal`` is 0 in the progress.
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def stream_state(spark: SparkSession, on_disk: bool = False) -> Iterator[None]:
    """Streams started inside keep their state in as many partitions as there are cores.

    A stream keeps the number it starts with for good, and unlike a batch it is
    not coalesced: each partition is a state store to commit in every micro-batch. What the
    watermark has passed is cleared by the next batch with data, not by one of its own.
    With ``on_disk`` their state may be larger than the memory of the executors.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    if on_disk:
        # What the session has chosen itself stays.
        wanted |= {name: value for name, value in _ON_DISK.items() if spark.conf.get(name, None) is None}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster one machine's disk is invisible to the others and is lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="cardvigil-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in files.listStatus(folder)] if files.exists(folder) else []


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder on its file system; raises ``OSError`` if that was not done."""
    folder, place = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (path, to))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).rename(folder, place):
        raise OSError(f"cannot move {path} to {to}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder this run has made, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder below the shared one, deleted at the end, also of a failure."""
    path = new_folder(spark, name)
    try:
        yield path
    finally:
        remove_folder(spark, path)
