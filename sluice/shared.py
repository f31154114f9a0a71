"""The folder that driver and executors share, and tables kept there."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, or a temporary one only where that is unset (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="stream-")


_CUTS: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("cuts", default=None)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: reading it again gives the same rows in the same partitions."""
    jsc = df.sparkSession.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        df.sparkSession.sparkContext.setCheckpointDir(scratch(df.sparkSession))
    out = df.checkpoint()
    if (held := _CUTS.get()) is not None:
        held.append(out)
    return out


@contextlib.contextmanager
def passing() -> Iterator[None]:
    """What cut() keeps within is deleted at the end; for work that is written by then, as in a micro-batch."""
    token = _CUTS.set([])
    try:
        yield
    finally:
        for df in _CUTS.get():
            kept = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
            if kept.isDefined():
                files, at = filesystem(df.sparkSession, kept.get())
                files.delete(at, True)
        _CUTS.reset(token)


#: State of streams on disk, without files that are allocated ahead: with many small partitions these would be most of it.
ON_DISK = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


@contextlib.contextmanager
def on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state on disk; afterwards the session's settings are as they were."""
    old = {name: spark.conf.get(name, None) for name in ON_DISK}
    for name, value in ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not, whatever the case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def filesystem(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as the JVM knows them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = filesystem(spark, path)
    return files.exists(at)
