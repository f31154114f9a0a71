"""Rows cut into batches by count, size and budget."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.shared import cut, fresh


def numbered(df: DataFrame, order: Sequence[str], into: str = "_n", keys: Sequence[str] = ()) -> DataFrame:
    """Rows numbered from 0 in order, over all or within each key: sorted by ranges, counted by partition, then numbered.

    A window over all rows, or over a key that holds a large part of them, would be one task; here a key can lie in many
    partitions, and only counts of keys by partition are put together. The sorted rows are kept in the shared folder,
    as both steps have to see the same ranges.
    """
    part, offset = fresh(df, "_part"), fresh(df, "_offset")
    ranged = cut(df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, part).agg(F.count("*").alias(offset))
    offsets = counts.withColumn(offset, F.coalesce(F.sum(offset).over(before), F.lit(0)))
    if not keys:
        met = ranged.join(F.broadcast(offsets), part)  # one row for each partition
    else:
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, part]]
        met = ranged.alias("l").join(offsets.alias("r"), same).select("l.*", F.col(f"r.{offset}"))
    return met.withColumn(into, F.row_number().over(Window.partitionBy(*keys, part).orderBy(*order)) - 1 + F.col(offset)).drop(part, offset)


def chunk_by_count(df: DataFrame, n: int, order: Sequence[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """batch_id from 0 in order, n rows each, by key or over all."""
    at = fresh(df, "_n")
    return numbered(df, order, at, keys).withColumn("batch_id", F.floor(F.col(at) / n).cast("long")).drop(at)


def chunk_by_bytes(df: DataFrame, max_len: int, overhead: int, size: str, order: Sequence[str], keys: Sequence[str], rows: int = 500) -> DataFrame:
    """keys, order, size, batch_id and packet: within each key's batches of ``rows`` rows, packets from 0 in order.

    A packet is filled while size and overhead fit; a larger row has one of its own. The fill depends on what came
    before, so a batch is one group, and the count bounds it, whatever a key holds. Other columns are left out: join
    them by key and order where they are needed.
    """
    budget = max_len - overhead
    if budget <= 0:
        raise ValueError(f"{max_len} bytes don't hold an overhead of {overhead}")
    slim = chunk_by_count(df.select(*keys, *[c for c in order if c not in keys], size), rows, order, tuple(keys))
    schema = slim.withColumn("packet", F.lit(0).cast("long")).schema

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(list(order), kind="stable")
        packets, packet, held = [], 0, 0
        for one in rows[size]:
            if held and held + one > budget:
                packet, held = packet + 1, 0
            packets.append(packet)
            held += one
        return rows.assign(packet=packets)

    return slim.groupBy(*keys, "batch_id").applyInPandas(fill, schema)


def budgeted(batches: DataFrame, budget: int | None, pipeline: str = "pipeline", batch: str = "batch_id", n: str = "n_rows") -> DataFrame:
    """Whole batches of each pipeline while less than the budget was shipped before; None is the first batch only."""
    within = Window.partitionBy(pipeline).orderBy(batch)
    if budget is None:
        return batches.withColumn("_rank", F.row_number().over(within)).where("_rank = 1").drop("_rank")
    before = F.coalesce(F.sum(n).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return batches.withColumn("_before", before).where(F.col("_before") < budget).drop("_before")
