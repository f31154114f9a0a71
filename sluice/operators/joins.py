"""Joins of queues, cycles, destinations and delivery state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import cycle_floor


def owed_by_destination(queue: DataFrame, subscriptions: DataFrame, cursors: DataFrame, targets: tuple[str, ...] = ("target_table",), dest: str = "dest_id", id_col: str = "id") -> DataFrame:
    """Queue rows by each destination that subscribes to their target, past that destination's cursor.

    Subscriptions carry their cursors before they meet the queue, so the queue is read and shuffled once at most.
    """
    wanted = subscriptions.join(cursors.select(*targets, dest, "cursor"), [*targets, dest], "left").select(*targets, dest, F.coalesce("cursor", F.lit(0)).alias("_cursor"))
    return queue.join(wanted, list(targets)).where(F.col(id_col) > F.col("_cursor")).drop("_cursor")


def ride_along(cycles: DataFrame, side: DataFrame, time: str = "time", cycle: str = "cycle", keys: tuple[str, ...] = (), seconds: int = 120, how: str = "inner") -> DataFrame:
    """Rows of a side table with the cycle that they fall in: start <= time < start + seconds.

    Cycles lie on a grid, so the range is an equality of the floored time. ``full`` and ``left`` keep cycles without
    rows; ``right`` and ``full`` keep rows whose cycle isn't there.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(how)
    dealt = side.withColumn(cycle, cycle_floor(F.col(time), seconds))
    return cycles.select(*keys, cycle).distinct().join(dealt, [*keys, cycle], how)


def ride_along_off_grid(cycles: DataFrame, side: DataFrame, time: str = "time", start: str = "start", seconds: int = 120) -> DataFrame:
    """As ride_along for starts at any second: each start is dealt to the two grid cells that its range touches."""
    cell = F.explode(F.array(*[F.floor(F.unix_timestamp(start) / seconds) + i for i in (0, 1)]))
    met = cycles.withColumn("_cell", cell).join(side.withColumn("_cell", F.floor(F.unix_timestamp(time) / seconds)), "_cell")
    return met.where((F.col(time) >= F.col(start)) & (F.unix_timestamp(time) - F.unix_timestamp(start) < seconds)).drop("_cell")


def missing_reporters(present: DataFrame, expected: Sequence[str] | DataFrame, keys: tuple[str, ...] = (), cycle: str = "cycle", reporter: str = "reporter") -> DataFrame:
    """For each key and cycle the expected reporters that have no row.

    A list is compared inside the group; a table (keys, reporter) is joined by key, so it may differ by station.
    """
    on = [*keys, cycle]
    if isinstance(expected, DataFrame):
        seen = present.select(*on, reporter).distinct()
        cycles = seen.select(*on).distinct()
        wanted = cycles.join(expected.select(*keys, reporter).distinct(), list(keys)) if keys else cycles.join(F.broadcast(expected.agg(F.collect_set(reporter).alias("_all"))), F.lit(True)).select(*on, F.explode("_all").alias(reporter))
        return wanted.join(seen, [*on, reporter], "left_anti")
    wanted = F.array(*[F.lit(e.strip()) for e in expected]) if expected else F.array().cast("array<string>")
    seen = present.groupBy(*on).agg(F.collect_set(F.col(reporter).cast("string")).alias("_seen"))
    return seen.select(*on, F.explode(F.array_except(wanted, "_seen")).alias(reporter))


def drain_gate(owed: DataFrame, deliverables: DataFrame, pipeline: str = "pipeline") -> DataFrame:
    """Owed rows of pipelines that have nothing waiting to be tried again."""
    return owed.join(deliverables.select(pipeline).distinct(), pipeline, "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], value: str, default: Column) -> DataFrame:
    """A column from a dimension table, or a default where it has no row."""
    return df.join(dimension.select(*on, F.col(value).alias("_value")), list(on), "left").withColumn(value, F.coalesce("_value", default)).drop("_value")


def orphans(queue: DataFrame, subscriptions: DataFrame, anchors: DataFrame, targets: tuple[str, ...] = ("target_table",), id_col: str = "id") -> DataFrame:
    """Rows that no destination will ever get, by target: those without a subscription, and those at or before the
    least anchor of a target's destinations."""
    subscribed = subscriptions.select(*targets).distinct().withColumn("_subscribed", F.lit(True))
    least = anchors.groupBy(*targets).agg(F.min("cursor").alias("_least"))
    read = queue.join(subscribed, list(targets), "left").join(least, list(targets), "left")
    why = F.when(F.col("_subscribed").isNull(), "no subscription").when(F.col(id_col) <= F.col("_least"), "before start")
    return read.select(*targets, why.alias("why")).where("why is not null").groupBy(*targets, "why").agg(F.count("*").alias("n_rows"))
