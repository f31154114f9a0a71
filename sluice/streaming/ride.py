"""Rows of a side stream that ride along with the cycles of another, with bounded state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import cycle_floor
from sluice.shared import fresh


def ride_along_stream(cycles: DataFrame, side: DataFrame, time: str = "time", cycle: str = "cycle", keys: tuple[str, ...] = (), seconds: int = 120, how: str = "inner", late: str = "10 minutes") -> DataFrame:
    """ride_along() of two streams: rows of ``side`` with the cycle that they fall in, start <= time < start + seconds.

    Both sides can be ``late`` behind the latest time seen; what is later is dropped. A cycle is kept once, and state of
    either side goes when the watermark passes the other end of its range, so it is bounded by ``seconds`` and ``late``.
    ``left`` keeps cycles without rows and ``right`` rows without a cycle, which come when their time is over.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(how)
    names = [f"{n}_side" for n in (*keys, cycle)]
    cell = fresh(side, "_cell")
    own = cycles.select(*keys, F.col(cycle).cast("timestamp").alias(cycle)).withWatermark(cycle, late).dropDuplicates([*keys, cycle])
    dealt = side.withColumn(time, F.col(time).cast("timestamp")).withColumn(cell, cycle_floor(F.col(time), seconds)).withWatermark(time, late)
    for k, n in zip(keys, names, strict=False):
        dealt = dealt.withColumnRenamed(k, n)
    length = F.make_dt_interval(secs=F.lit(seconds))
    on = [F.col(k) == F.col(n) for k, n in zip(keys, names, strict=False)] + [F.col(cycle) == F.col(cell), F.col(time) >= F.col(cycle), F.col(time) < F.col(cycle) + length]
    met = own.join(dealt, reduce(Column.__and__, on), how)
    if how == "right":
        met = met.withColumns({k: F.col(n) for k, n in zip(keys, names, strict=False)} | {cycle: F.coalesce(cycle, cell)})
    return met.drop(cell, *names[: len(keys)])
