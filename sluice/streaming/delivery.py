"""Delivery of batches and micro-batches, and replays of what was frozen, by a function of the user's."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import BooleanType, IntegralType, LongType, StringType, StructField, StructType

from sluice.operators.chunk import chunk_by_count
from sluice.operators.state import KINDS, RetryPolicy, apply_outcomes, due, fold_replays, same
from sluice.shared import cut, exists, filesystem, fresh, passing
from sluice.sources.spool import freeze_payload, frozen_payloads, payload_bucket


@dataclass(frozen=True)
class Sent:
    """What a destination made of a batch: acked, partial_ack, retry_later or permanent.

    A partial_ack names the last id that was accepted; rows after it stay owed.
    """

    kind: str
    reason: str = ""
    accepted_cursor: int | None = None
    rejected: int = 0
    n_bytes: int | None = None


#: send(deliverable_id, rows) -> Sent, or its kind, or (kind, reason).
Send = Callable[[int, pd.DataFrame], Sent | str | tuple[str, str]]
OUTCOME = "deliverable_id long, pipeline string, kind string, reason string, accepted_cursor long, records long, rejected long, n_bytes long, cursor_after long, ts timestamp"


def said(send: Send, deliverable: int, rows: pd.DataFrame) -> Sent:
    """What send makes of a batch. A failure is retry_later with its reason, and so is a kind that isn't known."""
    try:
        answer = send(deliverable, rows)
        answer = answer if isinstance(answer, Sent) else Sent(*answer) if isinstance(answer, tuple) else Sent(answer)
    except Exception as e:  # any failure of the other side means to try again
        return Sent("retry_later", f"{type(e).__name__}: {e}")
    return answer if answer.kind in KINDS else Sent("retry_later", f"unknown outcome kind: {answer.kind}")


def _batches(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Keys (None for null) and rows of each run of equal keys in sorted frames; a run can go on in the next frame."""
    key, held = None, []
    for frame in frames:
        if not len(frame):
            continue
        columns = [frame[k].astype(object).where(frame[k].notna(), None).to_numpy(object) for k in keys]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = np.flatnonzero(np.r_[True, new])
        for lo, hi in zip(starts, [*starts[1:], len(frame)], strict=True):
            own = tuple(c[lo] for c in columns)
            if held and own != key:
                yield key, pd.concat(held, ignore_index=True)
                held = []
            key, held = own, [*held, frame.iloc[lo:hi]]
    if held:
        yield key, pd.concat(held, ignore_index=True)


def deliver(df: DataFrame, send: Send, batch: str = "batch_id", id_col: str = "id", order: Sequence[str] = ("id",), pipeline: Column | None = None, now: datetime | None = None) -> DataFrame:
    """An outcome for each batch of each pipeline, as apply_outcomes() and apply_replays() take them: tasks call ``send``
    with a batch's rows, which keep all their columns.

    A batch is one call, so cap batches by count before. A failure of the function is retry_later with its reason.
    Tasks can run twice: send should know a batch by its id, which has to be unique over all deliveries of a pipeline.
    ``now`` is the time of the call unless given. Batches are runs of sorted rows, of which many come to Python at once.
    """
    of, key = fresh(df, "_pipeline"), fresh(df, "_batch")
    types = dict(c.split() for c in OUTCOME.split(", "))
    # Whole numbers and booleans come without nulls, so that a null in one batch changes no type in another.
    whole = {f.name: fresh(df, f"_null_{f.name}") for f in df.schema if f.nullable and isinstance(f.dataType, (IntegralType, BooleanType))}
    plain = [F.coalesce(F.col(f"`{f.name}`"), F.lit(False if isinstance(f.dataType, BooleanType) else 0).cast(f.dataType)).alias(f.name) if f.name in whole else F.col(f"`{f.name}`") for f in df.schema]
    marks = [F.col(f"`{c}`").isNull().alias(mark) for c, mark in whole.items()]

    def outcome(keys: tuple, rows: pd.DataFrame) -> tuple:
        deliverable, name = None if keys[0] is None else int(keys[0]), keys[1]
        last = rows[id_col][~rows[whole[id_col]]].max() if id_col in whole else rows[id_col].max()
        for c, mark in whole.items():
            if (none := rows[mark]).any():
                rows[c] = rows[c].astype(object if rows[c].dtype == bool else float).where(~none, None)
        answer, ts = said(send, deliverable, rows.drop(columns=[of, key, *whole.values()])), now or datetime.now(timezone.utc)
        return deliverable, name, answer.kind, answer.reason, answer.accepted_cursor, len(rows), answer.rejected, answer.n_bytes, None if pd.isna(last) else last, ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []

        def out() -> pd.DataFrame:
            return pd.DataFrame({c: pd.array(x, dtype="Int64") if kind == "long" else x for (c, kind), x in zip(types.items(), map(list, zip(*done, strict=True)), strict=True)})

        for keys, rows in _batches(frames, (key, of)):
            done.append(outcome(keys, rows))
            if len(done) == 1000:
                yield out()
                done.clear()
        if done:
            yield out()

    name = F.lit(None).cast("string") if pipeline is None else pipeline.cast("string")
    ready = df.withColumns({of: name, key: F.col(batch).cast("long").cast("string")}).select(*plain, *marks, of, key)
    last = [c for one in order for c in ([F.col(whole[one])] if one in whole else []) + [F.col(one).asc_nulls_last()]]
    return ready.repartition(key, of).sortWithinPartitions(of, key, *last).mapInPandas(run, OUTCOME)


def replay(due: DataFrame, payloads: DataFrame, send: Send, key: str = "deliverable_id", id_col: str = "id", order: Sequence[str] = ("id",), now: datetime | None = None) -> DataFrame:
    """Outcomes of deliverables (id, pipeline) whose time has come, sent again with the rows that were frozen for them.

    ``payloads`` has the rows by pipeline and ``key``; only those of a store for one pipeline can lack the pipeline. Where
    they have a bucket (frozen_payloads(places=True)), the join prunes folders by it. A deliverable without any rows is
    a permanent failure, as no retry could mend it.
    """
    of = fresh(payloads, "_of")
    keys = [key, *(["pipeline"] if "pipeline" in payloads.columns else [])]
    waiting = due.select(F.col("id").alias(key), "pipeline").withColumn(of, F.col("pipeline"))
    places = [c for c in ("bucket", "epoch") if c in payloads.columns]
    on = same(keys)
    if "bucket" in places:
        waiting = waiting.withColumn("bucket", payload_bucket(*[F.col(k) for k in reversed(keys)]))
        on = on & (F.col("l.bucket") == F.col("r.bucket"))
    met = payloads.alias("l").join(waiting.alias("r"), on).select("l.*", f"r.{of}").drop(*places)
    sent = deliver(met, lambda i, rows: send(i, rows.drop(columns=of)), key, id_col, order, F.col(of), now)
    at = F.current_timestamp() if now is None else F.lit(now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now)
    lost = waiting.alias("l").join(payloads.alias("r"), same(keys), "left_anti")
    none = lambda kind: F.lit(None).cast(kind)
    return sent.unionByName(lost.select(F.col(key).alias("deliverable_id"), F.col(of).alias("pipeline"), F.lit("permanent").alias("kind"), F.lit("no payload was frozen").alias("reason"), none("long").alias("accepted_cursor"), F.lit(0).cast("long").alias("records"), F.lit(0).cast("long").alias("rejected"), none("long").alias("n_bytes"), none("long").alias("cursor_after"), at.alias("ts")))


#: Batches of one epoch have ids below this, and an epoch's begin at its number times this.
EPOCH = 1 << 32
#: What a payload is known by.
KEYS = ("pipeline", "deliverable_id")


def unsettled(rows: DataFrame, outcomes: DataFrame, id_col: str = "id") -> DataFrame:
    """Of rows (pipeline, deliverable_id and more) those that no destination has: all of a batch that is to be tried
    again or is dead, and of a partial_ack those after its accepted cursor, all if it names none."""
    left = outcomes.where("kind IN ('retry_later', 'permanent', 'partial_ack')").select(*KEYS, "kind", "accepted_cursor")
    met = rows.alias("l").join(left.alias("r"), same(KEYS))
    return met.where((F.col("r.kind") != "partial_ack") | F.col("r.accepted_cursor").isNull() | (F.col(f"l.{id_col}") > F.col("r.accepted_cursor"))).select("l.*")


def deliver_stream(df: DataFrame, send: Send, log: str, checkpoint: str, batch_rows: int = 1000, id_col: str = "id", pipeline: str | Column = "stream", now: datetime | None = None) -> DataStreamWriter:
    """A stream's writer: each micro-batch is cut, sent, and its outcomes written under its epoch; what wasn't taken is
    frozen under the same epoch, and replay_stream() sends it again.

    Batches are those of a pipeline, which is a name or a column of rows; their ids are unique over its epochs and the
    same whenever an epoch is tried again. Outcomes and payloads of the try before are overwritten. The rest of a
    partial_ack waits as a deliverable of its batch's id, since a stream doesn't offer rows again. Rows are frozen before
    outcomes are written, so an outcome that waits always has its rows. Columns pipeline, deliverable_id and batch_id of
    the rows give way to the delivery's own; ids have to be unique in a pipeline, and rows without one come first. Dead
    letters' rows are frozen as well.
    """

    def epoch(rows: DataFrame, n: int) -> None:
        with passing():
            named = rows.withColumn("pipeline", F.lit(pipeline) if isinstance(pipeline, str) else pipeline.cast("string"))
            ready = cut(chunk_by_count(named, batch_rows, (id_col,), ("pipeline",)).withColumn("deliverable_id", F.col("batch_id") + n * EPOCH).drop("batch_id"))
            outcomes = cut(deliver(ready, send, "deliverable_id", id_col, (id_col,), F.col("pipeline"), now))
            freeze_payload(unsettled(ready, outcomes, id_col), f"{log}/_payloads", KEYS, n)
            outcomes.write.mode("overwrite").parquet(f"{log}/epoch={n}")

    return df.writeStream.foreachBatch(epoch).option("checkpointLocation", checkpoint)


def logged(spark: SparkSession, log: str, policy: RetryPolicy = RetryPolicy()) -> dict[str, DataFrame]:
    """What a delivery log comes to: deliverables that wait, dead letters, and attempts of outcomes and replays.

    The rest of a partial_ack waits like a batch that failed. There are no cursors: a stream's checkpoint is its cursor.
    """
    schema, at = StructType.fromDDL(OUTCOME), lambda part: f"{log}/{part}".rstrip("/")
    read = lambda part, by: spark.read.schema(StructType([*schema.fields, StructField(by, LongType())])).parquet(at(part)) if exists(spark, at(part)) else spark.createDataFrame([], StructType([*schema.fields, StructField(by, LongType())]))
    first, again = read("", "epoch"), read("_replays", "run")
    rest = F.col("accepted_cursor").isNull() | (F.col("accepted_cursor") < F.col("cursor_after"))
    waits = first.withColumn("kind", F.when((F.col("kind") == "partial_ack") & rest, "retry_later").otherwise(F.col("kind")))
    folded, after = apply_outcomes(waits, policy), fold_replays(apply_outcomes(waits, policy)["deliverables"], again, policy)
    return {"deliverables": after["deliverables"], "dead_letters": folded["dead_letters"].unionByName(after["dead_letters"]), "attempts": first.select("ts", "pipeline", "deliverable_id", "kind", "records").unionByName(again.select("ts", "pipeline", "deliverable_id", "kind", "records"))}


def replay_stream(spark: SparkSession, send: Send, log: str, schema: StructType, run: int, policy: RetryPolicy = RetryPolicy(), now: datetime | None = None, id_col: str = "id", most: int | None = None) -> int:
    """Sends what waits in a delivery log and whose time has come, once, and logs it as replay number ``run``.

    ``schema`` is of the stream's rows. A run that is tried again replaces what it had logged. Returns how many were sent.
    """
    at = F.current_timestamp() if now is None else F.lit(now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now)
    files, place = filesystem(spark, f"{log}/_replays/run={run}")
    files.delete(place, True)
    have = StructType([f for f in schema.fields if f.name not in KEYS] + [StructField("pipeline", StringType()), StructField("deliverable_id", LongType())])
    with passing():
        ready = due(logged(spark, log, policy)["deliverables"], at)
        ready = cut(ready if most is None else ready.limit(most))
        sent = replay(ready, frozen_payloads(spark, f"{log}/_payloads", have, places=True), send, id_col=id_col, order=(id_col,), now=now)
        sent.write.mode("overwrite").parquet(f"{log}/_replays/run={run}")
        return ready.count()


def drain(writer: DataStreamWriter, timeout: int | None = None) -> None:
    """Runs a stream until all that is there has been taken."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    query.stop()
