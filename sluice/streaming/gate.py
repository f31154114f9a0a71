"""The completeness gate over a stream: a cycle is let through when complete, else at its backstop, in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sluice.functions.fields import cycle_floor

_OUT = "station string, cycle timestamp, complete boolean, missing string"
_BOTH = "part string, station string, cycle timestamp, complete boolean, missing string, id long, reporter string, time timestamp"
#: cycles that are open, each with the expected reporters seen (a row for each, one without for the cycle itself), and
#: the last cycle that has gone.
_STATE = "cycles array<long>, reporters array<string>, gone long"


def _gate(wanted: list[str], seconds: int, backstop: int, late: int, with_late: bool) -> Callable:
    """The state machine of a station; rows come as frames, which are taken in whole and not row by row."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cycles, reporters, gone = state.get if state.exists else ([], [], -1)
        open_ = {}
        for cycle, who in zip(cycles, reporters, strict=True):
            open_.setdefault(cycle, set()).update([who] if who is not None else [])
        before = gone
        for batch in batches:
            missed = batch[batch["cycle"] <= before]
            if with_late and len(missed):
                yield pd.DataFrame({"part": "late", "station": key[0], "cycle": pd.to_datetime(missed["cycle"], unit="s"), "complete": None, "missing": None, "id": missed["id"], "reporter": missed["reporter"], "time": missed["time"]})
            for cycle, who in batch.loc[batch["cycle"] > before, ["cycle", "reporter"]].drop_duplicates().itertuples(index=False):
                open_.setdefault(int(cycle), set()).update([who] if who in wanted else [])
        now, out = state.getCurrentWatermarkMs() / 1000 + late, []
        for cycle in sorted(open_):
            missing = [e for e in wanted if e not in open_[cycle]]
            if now < cycle + seconds or (missing and now < cycle + seconds + backstop):
                break
            out.append((key[0], pd.Timestamp(cycle, unit="s"), not missing, ",".join(missing)))
            del open_[cycle]
            gone = cycle
        flat = [(c, who) for c, seen in open_.items() for who in (None, *sorted(seen))]
        state.update(([c for c, _ in flat], [who for _, who in flat], gone))
        if open_:
            first = min(open_)
            limit = seconds + (backstop if len(open_[first]) < len(wanted) else 0)
            state.setTimeoutTimestamp(max((first + limit - late) * 1000, state.getCurrentWatermarkMs() + 1))
        shipped = pd.DataFrame(out, columns=["station", "cycle", "complete", "missing"])
        yield shipped.assign(part="cycle", id=None, reporter=None, time=pd.NaT) if with_late else shipped

    return step


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each station, cycle and reporter of a batch, with the latest time: a large station is few rows."""
    for batch in batches:
        least = pa.Table.from_batches([batch]).group_by(["station", "cycle", "reporter"]).aggregate([("time", "max")])
        yield from least.rename_columns({"time_max": "time"}).select(["station", "time", "reporter", "cycle"]).combine_chunks().to_batches()


def _read(df: DataFrame, station: str, time: str, reporter: str, seconds: int, *more) -> DataFrame:
    read = df.select(F.col(station).cast("string").alias("station"), F.col(time).cast("timestamp").alias("time"), F.col(reporter).cast("string").alias("reporter"), *more)
    return read.withColumn("cycle", F.unix_timestamp(cycle_floor(F.col("time"), seconds))).where("cycle is not null")


def cycle_gate_stream(df: DataFrame, expected: Sequence[str], backstop: int = 90, station: str = "station", time: str = "time", reporter: str = "reporter", seconds: int = 120) -> DataFrame:
    """station, cycle, complete and the missing reporters, a row for each cycle of each station, oldest first.

    A cycle waits for all before it. It goes once every expected reporter was seen and event time has passed its end,
    or at the latest when event time passes end plus backstop. State is a station's open cycles with the reporters
    seen. Rows without a time are left out, rows of cycles that have gone are ignored; gate_with_late() gives them.
    """
    wanted = sorted({e.strip() for e in expected})
    combined = _read(df, station, time, reporter, seconds).mapInArrow(_combined, "station string, time timestamp, reporter string, cycle long")
    timed = combined.withWatermark("time", "0 seconds")
    return timed.groupBy("station").applyInPandasWithState(_gate(wanted, seconds, backstop, 0, False), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def gate_with_late(df: DataFrame, expected: Sequence[str], late: int, backstop: int = 90, station: str = "station", time: str = "time", reporter: str = "reporter", id_col: str = "id", seconds: int = 120) -> DataFrame:
    """The gate's cycles (part 'cycle') and the rows that came after their cycle had gone (part 'late'), in one stream.

    Event time runs as in cycle_gate_stream(). The watermark lags ``late`` seconds behind it, and rows older than that
    never come through, so ``late`` bounds how late a row can be told. Every row goes to its station's state here.
    """
    wanted = sorted({e.strip() for e in expected})
    timed = _read(df, station, time, reporter, seconds, F.col(id_col).cast("long").alias("id")).withWatermark("time", f"{late} seconds")
    return timed.groupBy("station").applyInPandasWithState(_gate(wanted, seconds, backstop, late, True), _BOTH, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def alerts_stream(gated: DataFrame) -> DataFrame:
    """Cycles that the gate let through incomplete; the gate gives each cycle once, and so does this."""
    return gated.where("not complete").select("station", "cycle", "missing")
