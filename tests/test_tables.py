"""Tables that are rewritten while they are read, snapshots, leases, tallies, and deletes in tasks."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice.operators import claims, state
from sluice.sources import spool, versions
from sluice.streaming import tally
from sluice.types import QUEUE

T0 = datetime(2026, 5, 7, 0, 42)


def at(seconds):
    return F.lit(T0 + timedelta(seconds=seconds))


def queue(spark, ids, table="t"):
    return spark.createDataFrame([(i, "d", table, 1, "{}", "") for i in ids], QUEUE)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_reader_during_a_rewrite_loses_nothing(spark, tmp_path):
    """Rows that arrive while a queue is rewritten stay; a reader of the old version reads it to its end."""
    root, cursors = str(tmp_path / "q"), spark.createDataFrame([("t", "a", 5), ("t", "b", 7)], "target_table string, dest_id string, cursor long")
    versions.append(queue(spark, range(1, 11)), root)
    old = versions.read_version(spark, root, QUEUE)

    def change(rows):
        versions.append(queue(spark, [50]), root)  # another writer, before this one commits
        return versions.retained(rows, cursors)

    versions.rewrite(spark, root, QUEUE, change)
    assert ids(versions.read_version(spark, root, QUEUE)) == [6, 7, 8, 9, 10, 50] and ids(old) == list(range(1, 11))
    assert versions.vacuum(spark, root, 1) == 1 and ids(versions.read_version(spark, root, QUEUE)) == [6, 7, 8, 9, 10, 50]
    assert versions.compact_queue(spark, root, QUEUE, cursors) == 3


def test_two_rewrites_at_once(spark, tmp_path):
    """The one that comes second starts again from what the first has left."""
    root, calls = str(tmp_path / "q"), []
    versions.append(queue(spark, range(1, 5)), root)

    def change(rows):
        calls.append(ids(rows))
        if len(calls) == 1:
            versions.rewrite(spark, root, QUEUE, lambda r: r.where("id > 1"))
        return rows.where("id < 4")

    versions.rewrite(spark, root, QUEUE, change)
    assert calls == [[1, 2, 3, 4], [2, 3, 4]] and ids(versions.read_version(spark, root, QUEUE)) == [2, 3]


def test_a_failure_before_the_commit_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "q")
    assert ids(versions.read_version(spark, root, QUEUE)) == []
    versions.append(queue(spark, range(3)), root)
    with pytest.raises(Exception, match="no luck"):
        versions.rewrite(spark, root, QUEUE, lambda rows: rows.withColumn("id", F.raise_error(F.lit("no luck")).cast("long")))
    assert ids(versions.read_version(spark, root, QUEUE)) == [0, 1, 2] and versions.newest(spark, root) == 0
    assert not versions._commit(spark, root, 0, ["x"])  # the number is taken
    versions.compact_attempts(spark, root, QUEUE, 2, seq="id")
    assert ids(versions.read_version(spark, root, QUEUE)) == [1, 2]


def test_cursors_from_a_snapshot_read_the_tail_only(spark, tmp_path):
    log, snaps, schema, keys = str(tmp_path / "log"), str(tmp_path / "snaps"), "k string, cursor long, ts long, seq long", ("k",)
    kind = spark.createDataFrame([], schema).schema
    epochs = [[("a", 5, 1, 1), ("b", 9, 1, 2)], [("a", 3, 2, 1), (None, 1, 1, 1)], [("b", 1, 1, 1), ("c", 7, 5, 1)], [("a", 8, 2, 2)]]
    for n, rows in enumerate(epochs):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{log}/epoch={n}")
        whole = state.current_cursors(spark.read.schema(kind).parquet(*[f"{log}/epoch={i}" for i in range(n + 1)]), keys)
        found = versions.cursors_since(spark, log, snaps, kind, keys)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
        if n in (1, 2):
            assert versions.snapshot_cursors(spark, log, snaps, kind, keys, n) and not versions.snapshot_cursors(spark, log, snaps, kind, keys, n)
    read = [f for f in versions.cursors_since(spark, log, snaps, kind, keys).inputFiles() if "/log/" in f]
    assert read and all("epoch=3" in f for f in read)


def test_leases_are_of_one_owner(spark):
    waiting = spark.createDataFrame([(i, "p", T0, 0, T0, i) for i in range(6)], "id long, pipeline string, enqueued_at timestamp, attempts int, next_attempt_at timestamp, cursor_after long")
    log = claims.claim(waiting.where("id < 4"), "a", at(0), 10).unionByName(claims.claim(waiting.where("id > 1"), "b", at(0), 10))
    mine, theirs = (ids(claims.claimed(waiting, log, o, at(5))) for o in "ab")
    assert (mine, theirs) == ([0, 1, 2, 3], [4, 5]) and ids(claims.claimable(waiting, log, at(5))) == []
    assert ids(claims.claimable(waiting, log, at(10))) == list(range(6))  # leases have run out
    later = log.unionByName(claims.claim(waiting, "b", at(10), 10)).unionByName(claims.claim(waiting.where("id = 0"), "a", at(11), 10))
    assert ids(claims.claimed(waiting, later, "b", at(12))) == list(range(6)) and ids(claims.claimed(waiting, later, "a", at(12))) == []
    longer = log.unionByName(claims.claim(waiting.where("id = 1"), "a", at(8), 10)).unionByName(claims.release(waiting.where("id = 0"), "a", at(4))).unionByName(claims.release(waiting.where("id = 5"), "a", at(4)))
    assert ids(claims.claimed(waiting, longer, "a", at(12))) == [1] and ids(claims.claimable(waiting, longer, at(5))) == [0]
    assert claims.drop_ended(longer, at(12)).select("id").distinct().count() == 1
    assert claims.holders(log.withColumn("owner", F.lit(None).cast("string")), at(1)).count() == 0


def test_tallies_of_a_batch_and_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(["x", "y", "x", None, "z", "x"])], "id long, mode string")
    counted, seen = tally.observed_batch(df, "mode", ["x", "y"])
    counted.write.format("noop").mode("overwrite").save()
    want = {"x": 3, "y": 1, "(other)": 2}
    assert seen.get == want
    live = tally.Tallies("modes")
    spark.streams.addListener(live)
    for n in (1, 2):  # counts go on over a restart
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = tally.observed(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "modes", "mode", ["x", "y"])
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(60)
        assert live.wait(6 * n) == {k: v * n for k, v in want.items()}
    spark.streams.removeListener(live)


def test_many_files_are_deleted_by_tasks(spark, tmp_path):
    """Acknowledged files and what is empty then go, others stay, and a second run finds nothing to do."""
    root = tmp_path / "a b%20é"
    n = 20_000
    for d in range(40):
        (root / f"d{d % 4}" / f"e{d}").mkdir(parents=True)
    for i in range(n):
        (root / f"d{i % 4}" / f"e{i % 40}" / f"{i}.txt").touch()
    keep = 7  # of e7, one file failed
    paths = spark.range(n).where(F.col("id") != keep).select(F.format_string(f"file:{str(root).replace('%', '%%')}/d%d/e%d/%d.txt", F.col("id") % 4, F.col("id") % 40, "id").alias("path"))
    assert spool.delete_acked(paths, str(root)) == n - 1
    assert [str(p.relative_to(root)) for p in sorted(root.rglob("*"))] == ["d3", "d3/e7", "d3/e7/7.txt"]
    assert spool.delete_acked(paths.unionByName(spark.createDataFrame([(None,)], "path string")), str(root)) == 0
