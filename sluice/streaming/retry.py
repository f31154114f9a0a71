"""Delivery with its retries inside the stream: what fails waits in keyed state and is sent again by timers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from sluice.operators.state import RetryPolicy
from sluice.shared import fresh, on_disk
from sluice.streaming.delivery import Send, Sent, said

#: kind is acked, partial_ack, retry_later, permanent, or dead_letter for a batch that has used up its attempts.
ATTEMPT = "pipeline string, deliverable_id long, attempt int, kind string, reason string, records long, cursor_after long, ts timestamp"
_NAMES = [c.split()[0] for c in ATTEMPT.split(", ")]


def wait_ms(attempts: int, policy: RetryPolicy) -> int:
    """Milliseconds until the next try, as backoff() has them in seconds."""
    return int(1000 * min(policy.base**attempts, policy.cap_sec))


class Retrying(StatefulProcessor):
    """Sends the rows of a key as a batch; what wasn't taken stays in the key's state until its time, then goes again.

    State: first id of a batch -> attempts so far, when it is due, and its rows as Arrow. A batch that is taken, refused
    for good, or has failed max_attempts times leaves the state.
    """

    def __init__(self, send: Send, policy: RetryPolicy, id_col: str, of: str, block: str):
        self.send, self.policy, self.id_col, self.inner = send, policy, id_col, [of, block]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "id long", "attempts int, due long, payload binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(rows), ignore_index=True).drop(columns=self.inner, errors="ignore")
        yield self._send(key[0], held.sort_values(self.id_col, kind="stable", ignore_index=True), 0, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for (first,), (attempts, due, payload) in list(self.waiting.iterator()):
            if due <= now:
                self.waiting.removeKey((first,))
                yield self._send(key[0], pa.ipc.open_stream(bytes(payload)).read_pandas(), attempts, now)

    def _send(self, pipeline: str | None, rows: pd.DataFrame, attempt: int, now: int) -> pd.DataFrame:
        first = int(rows[self.id_col].iloc[0])
        rows.attrs["attempt"] = attempt
        answer, left, taken = said(self.send, first, rows), rows, 0
        if answer.kind == "partial_ack":
            left = rows if answer.accepted_cursor is None else rows[rows[self.id_col] > answer.accepted_cursor].reset_index(drop=True)
            taken = len(rows) - len(left)
            answer = answer if len(left) else replace(answer, kind="acked")
        if answer.kind in ("partial_ack", "retry_later"):
            answer = self._wait(left, attempt + 1, now, answer)
        counted = {"acked": len(rows), "partial_ack": taken}.get(answer.kind, len(left))
        row = (pipeline, first, attempt, answer.kind, answer.reason, counted, int(rows[self.id_col].iloc[-1]), pd.Timestamp(now, unit="ms"))
        return pd.DataFrame([row], columns=_NAMES).astype({"attempt": "int32"})

    def _wait(self, left: pd.DataFrame, attempts: int, now: int, answer: Sent) -> Sent:
        # a batch that was taken in part got on, so its rest starts anew
        attempts = 0 if answer.kind == "partial_ack" else attempts
        if attempts >= self.policy.max_attempts:
            return replace(answer, kind="dead_letter", reason=answer.reason or "max_attempts")
        out = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_pandas(left, preserve_index=False)
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        due = now + max(1, wait_ms(max(0, attempts - 1), self.policy))
        self.waiting.updateValue((int(left[self.id_col].iloc[0]),), (attempts, due, out.getvalue().to_pybytes()))
        self.handle.registerTimer(due)
        return answer

    def close(self) -> None:
        pass


def deliver_retrying(df: DataFrame, send: Send, batch_rows: int = 1000, id_col: str = "id", pipeline: Column | None = None, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """A stream of ATTEMPT rows, one for each call of ``send``; write it with start_retrying().

    Keys are pipelines and ranges of ``batch_rows`` ids, so a pipeline of any size is spread and a key's rows are
    bounded; the rows of a key in a micro-batch are a batch, known by its first id. A batch that fails waits for
    backoff(attempts) and dies at max_attempts; its rows are in the state meanwhile, which a restart brings back. Of a
    partial_ack the rows after the accepted cursor go on waiting, all if it names none. ``rows.attrs['attempt']`` tells
    ``send`` how often the batch has failed. Rows without an id can't be told apart over retries and fail the stream.
    """
    of, block = fresh(df, "_pipeline"), fresh(df, "_block")
    name = F.lit(None).cast("string") if pipeline is None else pipeline.cast("string")
    known = F.coalesce(F.col(id_col), F.raise_error(F.lit(f"a row without {id_col}")).cast("long"))
    keyed = df.withColumns({of: name, block: F.floor(known / batch_rows).cast("long")})
    processor = Retrying(send, policy, id_col, of, block)
    return keyed.groupBy(of, block).transformWithStateInPandas(processor, StructType.fromDDL(ATTEMPT), "Append", "ProcessingTime")


def start_retrying(attempts: DataFrame, log: str, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Runs deliver_retrying() into Parquet files; timers fire with the micro-batches, ``every`` so often."""
    with on_disk(attempts.sparkSession):
        writer: DataStreamWriter = attempts.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).outputMode("append")
        return writer.trigger(processingTime=every).start()


def run_until(query: StreamingQuery, done: Callable[[], bool], timeout: float = 300) -> None:
    """Lets a query run until ``done``, then stops it; a query that failed raises, and so does one that takes too long."""
    end = time.monotonic() + timeout
    try:
        while not done():
            if query.awaitTermination(0.5) or time.monotonic() > end:
                raise TimeoutError(f"not done after {timeout} s")
    finally:
        query.stop()
