"""Fixed time cycles: which are closed, complete, and may ship in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import cycle_floor, past_backstop
from sluice.operators.joins import ride_along


def start_cycle(now: Column, start_at: str = "now", seconds: int = 120) -> Column:
    """The cycle before the one that is running, or the epoch for the beginning."""
    if start_at == "beginning":
        return F.timestamp_seconds(F.lit(0))
    return cycle_floor(now, seconds) - F.make_dt_interval(secs=F.lit(seconds))


def closed_cycles(df: DataFrame, now: Column, after: Column | None = None, keys: tuple[str, ...] = (), time: str = "time", seconds: int = 120, buffer: int = 0) -> DataFrame:
    """Distinct cycles after ``after`` that end by now less a buffer; bounds are on the time itself, so scans see them."""
    before = cycle_floor(now, seconds, buffer)
    df = df.where(F.col(time) < before)
    if after is not None:
        df = df.where(F.col(time) >= after + F.make_dt_interval(secs=F.lit(seconds)))
    return df.select(*keys, cycle_floor(F.col(time), seconds).alias("cycle")).distinct()


def cycle_complete(df: DataFrame, expected: Sequence[str] | DataFrame, keys: tuple[str, ...] = (), cycle: str = "cycle", reporter: str = "reporter") -> DataFrame:
    """keys, cycle, n_seen (expected reporters with a row) and complete; nothing expected is complete.

    An expected table (keys, reporter) is counted by key; reporters are compared as they are, list entries trimmed.
    """
    on = [*keys, cycle]
    if isinstance(expected, DataFrame):
        wanted = expected.select(*keys, reporter).distinct()
        seen = df.select(*on, reporter).distinct().join(wanted.withColumn("_wanted", F.lit(1)), [*keys, reporter], "left")
        counts = seen.groupBy(*on).agg(F.count("_wanted").alias("n_seen"))
        need = wanted.groupBy(*keys).agg(F.count("*").alias("_need"))
        joined = counts.join(need, list(keys), "left") if keys else counts.join(F.broadcast(need), F.lit(True))
        return joined.select(*on, "n_seen", (F.col("n_seen") >= F.coalesce("_need", F.lit(0))).alias("complete"))
    names = sorted({e.strip() for e in expected})
    seen = F.count_distinct(F.when(F.col(reporter).isin(*names), F.col(reporter))) if names else F.lit(0).cast("long")
    return df.groupBy(*on).agg(seen.alias("n_seen")).withColumn("complete", F.col("n_seen") >= len(names))


def shippable_ceiling(cycles: DataFrame, now: Column, backstop: int = 90, keys: tuple[str, ...] = (), cycle: str = "cycle", seconds: int = 120) -> DataFrame:
    """The newest cycle of each key up to which all are complete or past the backstop: (keys, ceiling).

    ``cycles`` has keys, cycle and complete. The running cycle never counts; a null cycle (an unreadable time) blocks
    nothing. Keys with no such cycle have no row. The first blocker is an aggregate, and so is the last before it.
    """
    ready = F.col("complete") | past_backstop(F.col(cycle), now, backstop, seconds)
    closed = cycles.where(F.col(cycle) < cycle_floor(now, seconds)).withColumn("_ready", ready)
    on = list(keys)
    blocker = closed.groupBy(*on).agg(F.min(F.when(~F.col("_ready"), F.col(cycle))).alias("_blocker"))
    joined = closed.join(blocker, on) if on else closed.join(F.broadcast(blocker), F.lit(True))
    before = joined.where(F.col("_blocker").isNull() | (F.col(cycle) < F.col("_blocker")))
    return before.groupBy(*on).agg(F.max(cycle).alias("ceiling")).where("ceiling is not null")


def cycle_bundle(spots: DataFrame, noise: DataFrame, side: DataFrame | None = None, keys: tuple[str, ...] = (), time: str = "time", seconds: int = 120, how: str = "right") -> DataFrame:
    """Spots and noise with their cycle, and side rows that fall in it, tagged by ``part``; write it by cycle to bundle.

    ``how`` inner keeps side rows only of cycles that spots or noise have; right keeps the others as well.
    """
    both = spots.withColumn("part", F.lit("spots")).unionByName(noise.withColumn("part", F.lit("noise")), allowMissingColumns=True)
    both = both.withColumn("cycle", cycle_floor(F.col(time), seconds))
    if side is None:
        return both
    riding = ride_along(both, side, time, "cycle", keys, seconds, how).withColumn("part", F.lit("side"))
    return both.unionByName(riding, allowMissingColumns=True)


def cycle_balance(bundle: DataFrame, keys: tuple[str, ...] = (), cycle: str = "cycle") -> DataFrame:
    """keys, cycle, n_spots, n_noise and what is missing: spots-only, noise-only, or both."""
    counts = bundle.groupBy(*keys, cycle).agg(F.count_if(F.col("part") == "spots").alias("n_spots"), F.count_if(F.col("part") == "noise").alias("n_noise"))
    label = F.when(F.col("n_noise") == 0, "spots-only").when(F.col("n_spots") == 0, "noise-only").otherwise("both")
    return counts.withColumn("balance", label)


def backstop_alerts(cycles: DataFrame, missing: DataFrame, alerted: DataFrame, now: Column, backstop: int = 90, keys: tuple[str, ...] = (), cycle: str = "cycle", reporter: str = "reporter", seconds: int = 120) -> DataFrame:
    """Cycles that ship incomplete for lack of time, once each, with the reporters that are missing."""
    on = [*keys, cycle]
    forced = cycles.where(~F.col("complete") & past_backstop(F.col(cycle), now, backstop, seconds)).select(*on)
    names = missing.groupBy(*on).agg(F.array_join(F.sort_array(F.collect_set(reporter)), ",").alias("missing"))
    return forced.join(alerted.select(*on).distinct(), on, "left_anti").join(names, on, "left")


def late_rows(df: DataFrame, passed: DataFrame, keys: tuple[str, ...] = (), time: str = "time", seconds: int = 120) -> DataFrame:
    """Rows of cycles up to the one that a key has passed (keys, cycle): they came after their cycle shipped."""
    reached = passed.select(*keys, F.col("cycle").alias("_passed"))
    joined = df.join(reached, list(keys)) if keys else df.join(F.broadcast(reached.agg(F.max("_passed").alias("_passed"))), F.lit(True))
    return joined.where(cycle_floor(F.col(time), seconds) <= F.col("_passed")).drop("_passed")
