"""The queue table: an append-only table of versioned JSON records, read in slices past a cursor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.shared import exists
from sluice.types import QUEUE


def read_queue(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Queue rows with a fixed schema."""
    return spark.read.schema(QUEUE).options(**options).format(fmt).load(path)


def stream_queue(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 100, **options) -> DataFrame:
    """The same rows as a stream of files."""
    return spark.readStream.schema(QUEUE).options(maxFilesPerTrigger=files_per_trigger, **options).format(fmt).load(path)


def route(df: DataFrame, db: str | None = None, table: str | None = None) -> DataFrame:
    """Rows of one target; the equality reaches the scan."""
    for name, value in (("target_db", db), ("target_table", table)):
        df = df if value is None else df.where(F.col(name) == value)
    return df


def first_n(df: DataFrame, order: list, n: int | None, keys: tuple[str, ...] = ()) -> DataFrame:
    """The first n rows by order, of all or of each key; all rows for None.

    Without keys this is a top-n that tasks do before the driver sees n rows each; with keys ranks are cut early.
    """
    if n is None:
        return df
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def owed(df: DataFrame, cursor: int | DataFrame = 0, limit: int | None = None, keys: tuple[str, ...] = (), id_col: str = "id") -> DataFrame:
    """Rows past the cursor, the oldest ``limit`` of all or of each key. A cursor table has the keys and ``cursor``."""
    if isinstance(cursor, DataFrame):
        df = df.join(cursor.select(*keys, F.col("cursor").alias("_cursor")), list(keys), "left").where(F.col(id_col) > F.coalesce("_cursor", F.lit(0))).drop("_cursor")
    else:
        df = df.where(F.col(id_col) > cursor)
    return first_n(df, [id_col], limit, keys)


def slice_cursor(df: DataFrame, keys: tuple[str, ...] = (), id_col: str = "id") -> DataFrame:
    """The cursor after a slice: its greatest id, corrupt rows included, so take it before quarantine."""
    return df.groupBy(*keys).agg(F.max(id_col).alias("cursor"))


def start_anchor(df: DataFrame, start_at: str | Column = "now", time: Column | None = None, id_col: str = "id") -> DataFrame:
    """The first cursor of a new destination: 0 for beginning, the greatest id for now, or that before a time."""
    if isinstance(start_at, str) and start_at == "beginning":
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("cursor"))
    past = df if isinstance(start_at, str) else df.where(time < start_at)
    return past.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("cursor"))


def stored_anchor(df: DataFrame, path: str, start_at: str | Column = "now", time: Column | None = None, id_col: str = "id") -> DataFrame:
    """The anchor that was stored under ``path``, or that of start_anchor(), stored there first.

    A destination that starts again so goes on where it began, and loses no row that came in between.
    """
    spark = df.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        start_anchor(df, start_at, time, id_col).write.mode("overwrite").parquet(path)
    return spark.read.schema("cursor long").parquet(path)


def retained(df: DataFrame, cursors: DataFrame, targets: tuple[str, ...] = ("target_table",), id_col: str = "id") -> DataFrame:
    """What may not be deleted: rows past the least cursor among a target's destinations; targets without any stay."""
    least = cursors.groupBy(*targets).agg(F.min("cursor").alias("_least"))
    return df.join(least, list(targets), "left").where(F.col("_least").isNull() | (F.col(id_col) > F.col("_least"))).drop("_least")


def source_health(df: DataFrame, accepted: list[int], targets: tuple[str, ...] = ("target_table",), version: str = "schema_version", queued: str = "queued_at") -> DataFrame:
    """A status row for each target: ok, stale-schema if any version isn't accepted; rows, stale rows, newest."""
    stale = F.count_if(~F.col(version).isin(accepted)) if accepted else F.lit(0).cast("long")
    out = df.groupBy(*targets).agg(F.count("*").alias("n_rows"), stale.alias("n_stale"), F.max(queued).alias("newest"))
    return out.withColumn("status", F.when(F.col("n_stale") > 0, "stale-schema").otherwise("ok"))
