"""One row of many: the best observation, the best spot of a batch, the last noise row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.sources.queue import first_n


def best_of(df: DataFrame, partition_by: Sequence[str], order_by: str | Column, cursor: int | DataFrame = 0, limit: int | None = None, keys: tuple[str, ...] = (), id_col: str = "id", compat: bool = False) -> DataFrame:
    """The row of each group with the greatest ``order_by``, for groups with no row at or before the cursor.

    Ties keep the least id; a null order is least, so a group of nulls yields its least id. Rows come with
    ``first_id``, their group's least id: the next cursor is the greatest first_id of what was shipped, and the oldest
    ``limit`` by first_id are kept. ``compat`` orders and advances by the winner's id instead, which can lose a group
    whose first row lies before another's winner. Filters on the payload belong before, those on the cursor here: a
    group's rows at or before it must still be there. The maximum is an aggregate, so tasks reduce before the shuffle.
    """
    group = [*keys, *partition_by]
    value = order_by if isinstance(order_by, Column) else F.col(order_by)
    rank = F.struct(value.cast("double").alias("k"), (-F.col(id_col)).alias("id"))
    rest = [c for c in df.columns if c not in group]
    best = df.groupBy(*group).agg(F.max_by(F.struct(*rest), rank).alias("_best"), F.min(id_col).alias("first_id"))
    out = best.select(*group, "_best.*", "first_id")
    if isinstance(cursor, DataFrame):
        out = out.join(cursor.select(*keys, F.col("cursor").alias("_cursor")), list(keys), "left").withColumn("_cursor", F.coalesce("_cursor", F.lit(0)))
    else:
        out = out.withColumn("_cursor", F.lit(cursor))
    out = out.where(F.col("first_id") > F.col("_cursor")).drop("_cursor").select(*df.columns, "first_id")
    return first_n(out, [id_col if compat else "first_id"], limit, keys)


def best_of_window(df: DataFrame, partition_by: Sequence[str], order_by: str, cursor: int = 0, id_col: str = "id") -> DataFrame:
    """best_of by ranks: every row is shuffled and sorted, but columns of any kind go through."""
    within = Window.partitionBy(*partition_by)
    ranked = df.withColumn("first_id", F.min(id_col).over(within)).withColumn("_rank", F.row_number().over(within.orderBy(F.col(order_by).cast("double").desc_nulls_last(), id_col)))
    return ranked.where((F.col("_rank") == 1) & (F.col("first_id") > cursor)).drop("_rank")


def best_spot(df: DataFrame, keys: tuple[str, ...] = (), time: str = "time", call: str = "call", mhz: str = "mhz", snr: str = "snr", pos: str = "pos") -> DataFrame:
    """Of the spots of a batch with the same minute, call and frequency (to 0.0001 MHz) that with the most SNR.

    Ties keep the first position; a missing SNR is 0. Rows without a call, frequency or time pass as they are.
    """
    name = F.trim(call)
    complete = name.isNotNull() & (name != "") & F.col(mhz).isNotNull() & F.col(time).isNotNull()
    group = [*keys, F.date_trunc("minute", time).alias("_minute"), name.alias("_call"), F.bround(mhz, 4).alias("_mhz")]
    rank = F.struct(F.coalesce(F.col(snr).cast("double"), F.lit(0.0)), -F.col(pos))
    won = df.where(complete).groupBy(*group).agg(F.max_by(F.struct(*df.columns), rank).alias("_best")).select("_best.*")
    return won.unionByName(df.where(~F.coalesce(complete, F.lit(False))))


def noise_last_wins(df: DataFrame, keys: Sequence[str] = ("receiver", "band", "cycle"), id_col: str = "id") -> DataFrame:
    """The last row written for each receiver, band and cycle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), id_col).alias("_last")).select(*keys, "_last.*").select(*df.columns)
