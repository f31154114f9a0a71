"""Tables that are rewritten while they are read: folders of files, and numbered commits that list those which count.

A commit is one file, put in place by a rename that fails where the number is taken. A reader takes the newest commit
and sees its folders only; data of a write that never committed is never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.state import trim_attempts
from sluice.shared import exists, filesystem
from sluice.sources.queue import retained

_COMMITS = "_commits"


def newest(spark: SparkSession, root: str) -> int:
    """The number of the last commit, -1 for none."""
    if not exists(spark, f"{root}/{_COMMITS}"):
        return -1
    files, at = filesystem(spark, f"{root}/{_COMMITS}")
    names = (s.getPath().getName() for s in files.listStatus(at))
    return max((int(n) for n in names if n.isdigit()), default=-1)


def folders(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """The folders that a version has, by name."""
    version = newest(spark, root) if version is None else version
    return [] if version < 0 else json.loads(spark.read.option("wholetext", "true").text(f"{root}/{_COMMITS}/{version:012d}").first()[0])


def _commit(spark: SparkSession, root: str, version: int, names: list[str]) -> bool:
    """Puts a version in place; false if another writer has taken its number."""
    jvm, text = spark.sparkContext._jvm, json.dumps(names)
    files, at = filesystem(spark, f"{root}/{_COMMITS}/{version:012d}")
    if files.exists(at):
        return False
    _, new = filesystem(spark, f"{root}/{_COMMITS}/.{uuid.uuid4().hex}")
    out = files.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(at).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(new), files.makeQualified(at), none)
    except Exception as e:
        files.delete(new, False)
        if "already exists" in str(e):
            return False
        raise
    return True


def read_version(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named; later commits don't change what this reads."""
    names = folders(spark, root, version)
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def append(df: DataFrame, root: str) -> int:
    """Adds rows as a folder of their own and commits it; the version that has them."""
    name, spark = f"data-{uuid.uuid4().hex}", df.sparkSession
    df.write.parquet(f"{root}/{name}")
    while True:
        at = newest(spark, root)
        if _commit(spark, root, at + 1, [*folders(spark, root, at), name]):
            return at + 1


def rewrite(spark: SparkSession, root: str, schema: StructType, change: Callable[[DataFrame], DataFrame]) -> int:
    """Replaces the newest version by what ``change`` makes of it; the version that has it.

    Readers see the old rows or the new ones. Folders that were appended meanwhile stay beside the new ones, unchanged.
    If another rewrite came first, this one starts again from its result. What fails before the commit leaves the old.
    """
    while True:
        base = newest(spark, root)
        had, name = folders(spark, root, base), f"data-{uuid.uuid4().hex}"
        change(read_version(spark, root, schema, base)).write.parquet(f"{root}/{name}")
        while True:
            at = newest(spark, root)
            now = folders(spark, root, at)
            if not set(had) <= set(now):
                break
            if _commit(spark, root, at + 1, [name, *[n for n in now if n not in had]]):
                return at + 1


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes commits but for the newest ``keep``, and folders that only they have; how many folders went.

    Readers of older versions have to be done. Folders of writes that are under way aren't in any commit and stay.
    """
    files, at = filesystem(spark, f"{root}/{_COMMITS}")
    last = newest(spark, root)
    numbers = sorted(int(s.getPath().getName()) for s in files.listStatus(at) if s.getPath().getName().isdigit()) if last >= 0 else []
    old, kept = [n for n in numbers if n <= last - keep], [n for n in numbers if n > last - keep]
    unused = {n for v in old for n in folders(spark, root, v)} - {n for v in kept for n in folders(spark, root, v)}
    for v in old:
        files.delete(filesystem(spark, f"{root}/{_COMMITS}/{v:012d}")[1], False)
    for n in unused:
        files.delete(filesystem(spark, f"{root}/{n}")[1], True)
    return len(unused)


def compact_queue(spark: SparkSession, root: str, schema: StructType, cursors: DataFrame, targets: tuple[str, ...] = ("target_table",), files: int | None = None) -> int:
    """Rewrites a queue without the rows that every destination has passed; rows that arrive meanwhile stay."""
    return rewrite(spark, root, schema, lambda rows: retained(rows, cursors, targets) if files is None else retained(rows, cursors, targets).repartition(files))


def compact_attempts(spark: SparkSession, root: str, schema: StructType, n: int = 10_000, keys: tuple[str, ...] = (), seq: str = "seq") -> int:
    """Rewrites a log of attempts to the newest n of all or of each key."""
    return rewrite(spark, root, schema, lambda rows: trim_attempts(rows, n, keys, seq))


def cursors_since(spark: SparkSession, log: str, snapshots: str, schema: StructType, keys: tuple[str, ...], ts: str = "ts", seq: str = "seq") -> DataFrame:
    """keys, cursor and last_ack of a log of acknowledgements in folders epoch=n: the last snapshot and newer epochs.

    snapshot_cursors() leaves, with each key's latest acknowledgement, the epoch up to which it has read; the scan of the
    log lists the folders after that one only. The same rows as current_cursors() over the whole log.
    """
    return _folded(spark, log, snapshots, schema, keys, ts, seq).select(*keys, "latest.cursor", F.col("last_ack"))


def _folded(spark: SparkSession, log: str, snapshots: str, schema: StructType, keys: tuple[str, ...], ts: str, seq: str) -> DataFrame:
    upto = newest(spark, snapshots)
    files, at = filesystem(spark, log)
    epochs = [int(s.getPath().getName().split("=")[1]) for s in files.listStatus(at) if s.getPath().getName().startswith("epoch=")]
    tail = [f"{log}/epoch={n}" for n in sorted(epochs) if n > upto]
    rows = spark.read.schema(schema).parquet(*tail) if tail else spark.createDataFrame([], schema)
    latest = rows.groupBy(*keys).agg(F.max(F.struct(ts, seq, "cursor")).alias("latest"), F.max(ts).alias("last_ack"))
    if upto < 0:
        return latest
    before = read_version(spark, snapshots, latest.schema, upto)
    return before.unionByName(latest).groupBy(*keys).agg(F.max("latest").alias("latest"), F.max("last_ack").alias("last_ack"))


def snapshot_cursors(spark: SparkSession, log: str, snapshots: str, schema: StructType, keys: tuple[str, ...], epoch: int, ts: str = "ts", seq: str = "seq") -> bool:
    """Keeps the cursors up to ``epoch``, the newest of the log, so that later folds start there; false if it was kept already."""
    if newest(spark, snapshots) >= epoch:
        return False
    name = f"data-{uuid.uuid4().hex}"
    _folded(spark, log, snapshots, schema, keys, ts, seq).write.parquet(f"{snapshots}/{name}")
    return _commit(spark, snapshots, epoch, [name])
