"""Streams against the same rows in a batch."""

import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators import cycles, joins, state
from sluice.streaming import delivery, gate, retry, ride
from sluice.sources import queue, spool

T0 = datetime(2026, 5, 7, 0, 0)


def test_gate_lets_cycles_through_in_order(spark, tmp_path):
    """Cycle 0 is complete, 1 lacks B5 until its backstop, 2 is complete but waits for 1, 4 is still open."""
    at = lambda minutes: T0 + timedelta(minutes=minutes)
    steps = [[(at(0), "B4"), (at(1), "B5"), (at(2), "B4")], [(at(4), "B4"), (at(4), "B5"), (at(4.5), "B4")], [(at(8), "B4")], [(at(8.5), "XX")]]
    source = tmp_path / "in"
    for i, step in enumerate(steps):
        spark.createDataFrame([("s", t, r) for t, r in step], "station string, time timestamp, reporter string").coalesce(1).write.parquet(str(source / f"{i}"))
    stream = spark.readStream.schema("station string, time timestamp, reporter string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
    gated = gate.cycle_gate_stream(stream, ["B4", "B5"])
    query = gated.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = [(r.cycle, r.complete, r.missing) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("cycle").collect()]
    assert got == [(at(0), True, ""), (at(2), False, "B5"), (at(4), True, "")]


def test_delivery_is_logged_once(spark, tmp_path):
    sent = tmp_path / "sent"
    sent.mkdir()

    def send(batch: int, rows: pd.DataFrame):
        (sent / f"{batch}-{rows['id'].min()}").write_text(str(len(rows)))
        if rows["id"].max() > 20:
            raise ConnectionError("down")
        return "acked"

    df = spark.range(1, 26).select("id", F.lit("d").alias("target_db"), F.lit("t").alias("target_table"), F.lit(1).alias("schema_version"), F.lit("{}").alias("payload_json"), F.lit("").alias("queued_at"))
    df.coalesce(1).write.parquet(str(tmp_path / "q"))
    for _ in range(2):  # the second run has nothing left to take
        delivery.drain(delivery.deliver_stream(queue.stream_queue(spark, str(tmp_path / "q")), send, str(tmp_path / "log"), str(tmp_path / "check"), 10), 120)
    log = spark.read.parquet(str(tmp_path / "log"))
    first = [(0, "acked", 10, 10), (1, "acked", 10, 20), (2, "retry_later", 5, 25)]
    assert sorted((r.deliverable_id, r.kind, r.records, r.cursor_after) for r in log.collect()) == first
    assert len(list(sent.iterdir())) == 3
    df.withColumn("id", F.col("id") + 100).coalesce(1).write.mode("append").parquet(str(tmp_path / "q"))  # a second epoch
    delivery.drain(delivery.deliver_stream(queue.stream_queue(spark, str(tmp_path / "q")), send, str(tmp_path / "log"), str(tmp_path / "check"), 10), 120)
    ids = [(r.deliverable_id, r.epoch, r.cursor_after) for r in spark.read.parquet(str(tmp_path / "log")).collect()]
    assert len({i for i, *_ in ids}) == 6 and sorted(ids)[3:] == [(delivery.EPOCH + i, 1, at) for i, at in enumerate((110, 120, 125))]


def test_spool_stream_archives(spark, tmp_path):
    root, done = tmp_path / "spool", tmp_path / "done"
    root.mkdir()
    (root / "a.txt").write_text("x")
    stream = spool.spool_stream(spark, str(root), "keep")
    query = stream.select("path", "length").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().length == 1
    assert spool.spool_stream(spark, str(root), "archive", archive=str(done)).isStreaming


QUEUE = "id long, pipeline string, deliverable_id string, _pipeline string, _part int, text string"


def _arrive(spark, folder, ids, pipelines=("a", "b")):
    spark.createDataFrame([(i, p, "own", "mine", 7, f"{p}{i}") for p in pipelines for i in ids], QUEUE).coalesce(1).write.mode("append").parquet(str(folder))


def _taken(folder) -> list[str]:
    return sorted(line for f in folder.iterdir() for line in f.read_text().split())


def test_what_fails_is_frozen_and_sent_again(spark, tmp_path):
    """Two pipelines with the same ids and two epochs: b is down at first, a takes parts; in the end each row is taken once."""
    sink, log, source = tmp_path / "sink", str(tmp_path / "log"), tmp_path / "in"
    sink.mkdir()
    up = tmp_path / "up"

    def send(deliverable: int, rows: pd.DataFrame):
        assert set(rows.columns) >= {"_pipeline", "_part"} and rows["_pipeline"].eq("mine").all()
        name, first = rows["pipeline"].iloc[0], int(rows["id"].min())
        if name == "b" and not up.exists():
            raise ConnectionError("down")
        n = 2 if name == "a" and len(rows) == 3 else len(rows)
        (sink / f"{name}-{first}-{len(rows)}").write_text("\n".join(rows["text"].head(n)))
        if n < len(rows):
            return delivery.Sent("partial_ack", accepted_cursor=int(rows["id"].iloc[n - 1]), rejected=1)
        return "acked"

    def run():
        stream = spark.readStream.schema(QUEUE).parquet(str(source))
        delivery.drain(delivery.deliver_stream(stream.drop("deliverable_id"), send, log, str(tmp_path / "check"), 3, pipeline=F.col("pipeline"), now=T0), 120)

    for ids in (range(1, 6), range(6, 10)):
        _arrive(spark, source, ids)
        run()
    waits = delivery.logged(spark, log)["deliverables"]
    # of 5 rows a batch of 3 and one of 2, of 4 rows one of 3 and one of 1: all of b, and what a left of its threes
    assert sorted((r.pipeline, r.id, r.attempts) for r in waits.collect()) == [("a", 0, 0), ("a", delivery.EPOCH, 0), *[("b", e * delivery.EPOCH + i, 0) for e in (0, 1) for i in (0, 1)]]
    schema = spark.read.parquet(str(source)).drop("deliverable_id").schema
    again = lambda n, seconds: delivery.replay_stream(spark, send, log, schema, n, now=T0 + timedelta(seconds=seconds))
    assert again(0, 0) == 0  # nothing is due yet
    assert again(1, 5) == 6
    assert sorted((r.pipeline, r.id, r.attempts) for r in delivery.logged(spark, log)["deliverables"].collect()) == [("b", e * delivery.EPOCH + i, 1) for e in (0, 1) for i in (0, 1)]
    up.touch()
    assert again(2, 60) == 4 and again(3, 600) == 0
    assert _taken(sink) == sorted(f"{p}{i}" for p in "ab" for i in range(1, 10))
    ended = delivery.logged(spark, log)
    assert ended["deliverables"].count() == ended["dead_letters"].count() == 0


def test_an_epoch_tried_again_leaves_one_copy(spark, tmp_path):
    log = str(tmp_path / "log")

    def send(deliverable, rows):
        raise ConnectionError("down")

    def run():
        stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in")).drop("deliverable_id", "pipeline")
        delivery.drain(delivery.deliver_stream(stream, send, log, str(tmp_path / "check"), 4), 120)

    _arrive(spark, tmp_path / "in", range(1, 8), ("a",))
    run()
    before = len(list(tmp_path.glob("log/_payloads/epoch=0/*/*.parquet")))
    for f in tmp_path.glob("check/commits/*0*"):  # the commit was lost
        f.unlink()
    run()
    payloads = spark.read.parquet(f"{log}/_payloads")
    assert sorted(r.id for r in payloads.collect()) == list(range(1, 8)) and payloads.select("deliverable_id").distinct().count() == 2
    assert len(list(tmp_path.glob("log/_payloads/epoch=0/*/*.parquet"))) == before and spark.read.parquet(log).count() == 2


def test_micro_batches_leave_no_checkpoints(spark, tmp_path):
    from sluice import shared

    shared.cut(spark.range(1))
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    count = lambda: sum(len(d) for _, d, _ in os.walk(folder))
    before = count()
    _arrive(spark, tmp_path / "in", range(1, 8), ("a",))
    stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in")).drop("deliverable_id", "pipeline")
    delivery.drain(delivery.deliver_stream(stream, lambda i, rows: "acked", str(tmp_path / "log"), str(tmp_path / "check"), 4), 120)
    assert count() == before and spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_batches_reach_send_whole_and_apart(spark):
    """Runs of sorted rows over several Arrow batches: each batch is one call, a null in one changes no type in another, ids stay exact."""
    big = (1 << 60) + 1
    rows = [(i // 5, big + i, "p", True, "x") for i in range(23)] + [(0, big, None, None, "y"), (0, None, None, True, "y"), (None, 7, "p", False, "z")]
    df = spark.createDataFrame(rows, "batch_id long, id long, pipeline string, flag boolean, text string").repartition(3)

    columns = df.columns

    def send(batch, got):
        assert list(got.columns) == columns and list(got.index) == list(range(len(got)))
        ids = got["id"].dropna()
        assert ids.is_monotonic_increasing and got["id"].isna().tolist() == [False] * len(ids) + [True] * (len(got) - len(ids))
        return delivery.Sent("acked", f"{got['id'].dtype} {got['flag'].dtype} {','.join(got['text'].unique())}", n_bytes=big)

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        sent = delivery.deliver(df, send, pipeline=F.col("pipeline"), now=T0)
        assert "FlatMapGroups" not in sent._jdf.queryExecution().toString()  # a pandas frame made for each group took most of the time
        got = {(r.pipeline, r.deliverable_id): (r.kind, r.reason, r.records, r.cursor_after, r.n_bytes, r.accepted_cursor) for r in sent.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {("p", b): ("acked", "int64 bool x", min(5, 23 - 5 * b), big + min(5 * b + 4, 22), big, None) for b in range(5)}
    assert got == want | {(None, 0): ("acked", "float64 object y", 2, big, big, None), ("p", None): ("acked", "int64 bool z", 1, 7, big, None)}
    assert delivery.deliver(df.limit(0), send, now=T0).count() == 0


def test_kinds_that_are_not_known(spark):
    """A send that answers with something else is tried again; a fold that reads such a kind fails."""
    df = spark.createDataFrame([(0, 1), (0, 2)], "batch_id long, id long")
    sent = delivery.deliver(df, lambda i, rows: "ok", now=T0).collect()
    assert [(r.kind, r.reason) for r in sent] == [("retry_later", "unknown outcome kind: ok")]
    odd = spark.createDataFrame([(0, "p", "ok", "", None, 1, 0, None, 9, T0)], delivery.OUTCOME)
    for part in ("cursors", "deliverables", "dead_letters", "attempts"):
        with pytest.raises(Exception, match="unknown outcome kind: ok"):
            state.apply_outcomes(odd)[part].collect()


def test_retries_inside_the_stream(spark, tmp_path):
    """b fails twice and is then taken, c dies, a is taken in parts; the query is stopped in between and goes on from its state."""
    sink = tmp_path / "sink"
    sink.mkdir()
    rows = lambda df: sorted((r.pipeline, r.deliverable_id, r.attempt, r.kind, r.records) for r in df.collect())

    def send(deliverable: int, rows: pd.DataFrame):
        name, attempt = rows["pipeline"].iloc[0], rows.attrs["attempt"]
        if (name == "b" and attempt < 2) or name == "c":
            raise ConnectionError("down")
        n = 2 if name == "a" and len(rows) > 2 else len(rows)
        with (sink / f"{name}-{deliverable}-{attempt}").open("a") as f:
            f.write("\n".join(rows["text"].head(n)) + "\n")
        return delivery.Sent("partial_ack", accepted_cursor=int(rows["id"].iloc[n - 1])) if n < len(rows) else "acked"

    policy, log = state.RetryPolicy(base=1.0, max_attempts=3), str(tmp_path / "log")
    known = lambda: spark.read.schema(retry.ATTEMPT).parquet(log) if os.path.isdir(f"{log}/_spark_metadata") else spark.createDataFrame([], retry.ATTEMPT)

    def start():
        stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in"))
        return retry.start_retrying(retry.deliver_retrying(stream, send, 10, pipeline=F.col("pipeline"), policy=policy), log, str(tmp_path / "check"), "1 second")

    _arrive(spark, tmp_path / "in", [1, 2, 3, 11, 12], ("a", "b", "c"))
    retry.run_until(start(), lambda: known().where("kind = 'retry_later'").count() >= 4, 120)
    before = known().count()
    retry.run_until(start(), lambda: known().where("kind IN ('acked', 'dead_letter')").count() == 6, 120)
    got = rows(known())
    assert len(got) > before
    assert [x for x in got if x[0] == "b"] == [("b", 1, 0, "retry_later", 3), ("b", 1, 1, "retry_later", 3), ("b", 1, 2, "acked", 3), ("b", 11, 0, "retry_later", 2), ("b", 11, 1, "retry_later", 2), ("b", 11, 2, "acked", 2)]
    assert [x for x in got if x[0] == "c"] == [("c", i, t, k, n) for i, n in ((1, 3), (11, 2)) for t, k in ((0, "retry_later"), (1, "retry_later"), (2, "dead_letter"))]
    assert [x for x in got if x[0] == "a"] == [("a", 1, 0, "partial_ack", 2), ("a", 3, 0, "acked", 1), ("a", 11, 0, "acked", 2)]
    assert _taken(sink) == sorted(f"{p}{i}" for p in "ab" for i in (1, 2, 3, 11, 12))


def _stage(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def _drained(df, out, check):
    query = df.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(check)).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return query


def test_late_rows_come_out_of_the_gate(spark, tmp_path):
    """Rows of cycles that have gone, out of order and over a restart, are those that late_rows() finds."""
    at, schema = lambda m: T0 + timedelta(minutes=m), "id long, station string, time timestamp, reporter string"
    early = [(i, s, at(m), r) for i, (s, m, r) in enumerate([("s", 0, "B4"), ("s", 1, "B5"), ("s", 2, "B4"), ("s", 3, "B5"), ("t", 0, "B4"), ("s", 6, "B4"), ("t", 6, "B5")])]
    later = [(100 + i, s, at(m), r) for i, (s, m, r) in enumerate([("s", 3.5, "B4"), ("s", 0.5, "XX"), ("t", 1, "B5"), ("t", 4, "B4"), ("s", 7, "B5"), ("s", 7.5, None), ("u", 0, "B4")])]

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        _drained(gate.gate_with_late(stream, ["B4", "B5"], 86400), tmp_path / "out", tmp_path / "check")
        return spark.read.parquet(str(tmp_path / "out"))

    _stage(spark, tmp_path / "in", early, schema)
    passed = run().where("part = 'cycle'").groupBy("station").agg(F.max("cycle").alias("cycle"))
    assert sorted(map(tuple, passed.collect())) == [("s", at(2)), ("t", at(0))]
    passed = spark.createDataFrame(passed.collect(), passed.schema)
    _stage(spark, tmp_path / "in", later, schema)
    late = run().where("part = 'late'")
    want = cycles.late_rows(spark.createDataFrame(later, schema), passed, ("station",))
    got = sorted((r.id, r.station, r.reporter, r.time) for r in late.collect())
    assert got == sorted((r.id, r.station, r.reporter, r.time) for r in want.collect()) and [g[0] for g in got] == [100, 101, 102]


def test_ride_along_of_streams_ends_without_state(spark, tmp_path):
    """Two streams in several files, out of order within the lateness: the rows of ride_along(), and no state is left."""
    at = lambda s: T0 + timedelta(seconds=s)
    starts = [("a", at(0)), ("a", at(0)), ("b", at(120)), ("a", at(240)), ("a", at(600))]
    side = [("a", at(0), 1), ("a", at(119.5), 2), ("b", at(100), 3), ("b", at(239), 4), ("a", at(359), 5), ("a", at(360), 6), (None, at(5), 7)]
    far = at(86_400)
    for i in range(3):
        _stage(spark, tmp_path / "c", starts[i::3] + [("z", far)] * (i == 2), "station string, cycle timestamp")
        _stage(spark, tmp_path / "s", side[i::3] + [("y", far, 9)] * (i == 2), "station string, time timestamp, n long")
    read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
    for how in ("inner", "left", "right"):
        met = ride.ride_along_stream(read("c", "station string, cycle timestamp"), read("s", "station string, time timestamp, n long"), keys=("station",), how=how)
        query = _drained(met, tmp_path / f"out-{how}", tmp_path / f"check-{how}")
        want = joins.ride_along(spark.createDataFrame(starts, "station string, cycle timestamp"), spark.createDataFrame(side, "station string, time timestamp, n long"), keys=("station",), how=how)
        got = spark.read.parquet(str(tmp_path / f"out-{how}")).where("station IS NULL OR station NOT IN ('y', 'z')")
        assert sorted(map(str, got.select("station", "cycle", "time", "n").collect())) == sorted(map(str, want.select("station", "cycle", "time", "n").collect()))
        left = query.lastProgress["stateOperators"]
        assert sum(o["numRowsTotal"] for o in left) <= 3  # the rows that pushed the time on, and no others


def test_dead_letters_keep_their_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    _arrive(spark, tmp_path / "in", range(1, 5), ("a",))
    stream = spark.readStream.schema(QUEUE).parquet(str(tmp_path / "in")).drop("deliverable_id", "pipeline")
    delivery.drain(delivery.deliver_stream(stream, lambda i, rows: ("permanent", "refused") if rows["id"].min() == 1 else "acked", log, str(tmp_path / "check"), 3), 120)
    ended = delivery.logged(spark, log)
    assert [(r.pipeline, r.deliverable_id, r.final_error) for r in ended["dead_letters"].collect()] == [("stream", 0, "refused")] and ended["deliverables"].isEmpty()
    assert sorted((r.deliverable_id, r.id) for r in spark.read.parquet(f"{log}/_payloads").collect()) == [(0, 1), (0, 2), (0, 3)]
