"""The given tables read as queues, spots and delivery logs, in Spark and in SQL; both say the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a queue: the payload is props, its version k % 4, stations and reporters come from user_id."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.lit("main").alias("target_db"), F.col("event_type").alias("target_table"), (k % 4).alias("schema_version"), F.col("props").alias("payload_json"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("queued_at"), k.alias("k"), F.col("ts"), F.col("value"), F.col("user_id"), (F.col("user_id") % 10).alias("station"), (F.col("user_id") % 5).cast("string").alias("reporter"), F.to_date("ts").cast("string").alias("day"),
    )


QUEUE = """SELECT event_id AS id, event_type AS target_table, CAST(props->>'$.k' AS INT) % 4 AS schema_version, props AS payload_json,
 strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS queued_at, CAST(props->>'$.k' AS INT) AS k, ts, CAST(floor(epoch(ts)) AS BIGINT) AS e, value, user_id, user_id % 10 AS station,
 CAST(user_id % 5 AS VARCHAR) AS reporter, strftime(ts, '%Y-%m-%d') AS day FROM events"""

#: Frequencies in Hz, modes, and what is made of event numbers.
_HZ = [1838100, 3570100, 7040100, 14097100, 28126100, 50294500]
_MODES = ["W2", "F2", "F5", "ft8", "FT4", "msk144", "js8"]


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as spots with flat columns, some without a call, a grid or a usable call."""
    i, u = F.col("id"), F.col("user_id")
    letter = lambda c, n: F.char(65 + F.expr(f"cast({c} as int) % {n}"))
    four = F.concat(letter("user_id", 18), letter("user_id div 3", 18), (u % 10).cast("string"), (F.expr("user_id div 7") % 10).cast("string"))
    return queue(spark, sf_dir).select(
        "id", "ts", "station", "k", "value", "user_id", "reporter",
        F.when(i % 50 == 0, "<...>").when(i % 51 == 0, "").otherwise(F.concat(F.lit("K"), (u % 10).cast("string"), letter("user_id", 26), letter("user_id div 2", 26))).alias("call"),
        ((pick(_HZ, i) + (u % 3) * 100) / 1e6).alias("mhz"),
        F.when(i % 11 == 0, "").when(i % 2 == 0, F.concat(four, letter("user_id", 24), letter("user_id div 5", 24))).otherwise(four).alias("grid"),
        pick(_MODES, i).alias("mode"), (F.floor(F.col("value")) - 30).cast("double").alias("snr"), ((i % 9) / 8).alias("sync"), ((i % 5) * 0.25 - 0.5).alias("dt"), (F.lit(20) + i % 20).cast("long").alias("power"), (i % 5 - 2).cast("long").alias("drift"), (F.lit(2) + i % 2).cast("long").alias("kind"),
        F.when(i % 13 == 0, None).otherwise(F.concat(F.lit("radiod:rx"), (u % 4).cast("string"), F.lit("-status.local"))).alias("radiod_id"), F.concat(F.lit("AC0G/B"), (u % 4).cast("string")).alias("rx_call"), F.when(u % 4 == 3, "").otherwise(pick(["EM38ww", "FN42", "JN58"], u)).alias("rx_grid"),
    )


def _char(c: str, n: int) -> str:
    return f"chr(65 + CAST(({c}) % {n} AS INT))"


_FOUR = f"{_char('user_id', 18)} || {_char('user_id // 3', 18)} || (user_id % 10) || ((user_id // 7) % 10)"
SPOTS = f"""SELECT id, ts, e, station, k, value, user_id, reporter,
 CASE WHEN id % 50 = 0 THEN '<...>' WHEN id % 51 = 0 THEN '' ELSE 'K' || (user_id % 10) || {_char('user_id', 26)} || {_char('user_id // 2', 26)} END AS call,
 (({_HZ})[id % {len(_HZ)} + 1] + (user_id % 3) * 100) / 1e6 AS mhz,
 CASE WHEN id % 11 = 0 THEN '' WHEN id % 2 = 0 THEN {_FOUR} || {_char('user_id', 24)} || {_char('user_id // 5', 24)} ELSE {_FOUR} END AS grid,
 ({_MODES})[id % {len(_MODES)} + 1] AS mode, floor(value) - 30 AS snr, (id % 9) / 8.0::DOUBLE AS sync, (id % 5) * 0.25::DOUBLE - 0.5::DOUBLE AS dt, 20 + id % 20 AS power, id % 5 - 2 AS drift, 2 + id % 2 AS kind,
 CASE WHEN id % 13 = 0 THEN NULL ELSE 'radiod:rx' || (user_id % 4) || '-status.local' END AS radiod_id, 'AC0G/B' || (user_id % 4) AS rx_call,
 CASE WHEN user_id % 4 = 3 THEN '' ELSE (['EM38ww', 'FN42', 'JN58'])[user_id % 3 + 1] END AS rx_grid FROM ({QUEUE})"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as outcomes of first attempts: the kind is by event number, the pipeline the event type."""
    i = F.col("id")
    kind = pick(["acked", "retry_later", "acked", "partial_ack", "permanent", "acked", "retry_later"], i)
    return queue(spark, sf_dir).select(i.alias("deliverable_id"), F.col("target_table").alias("pipeline"), kind.alias("kind"), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("r"), (i % 4).cast("string"))).alias("reason"), (i - 1).alias("accepted_cursor"), (F.lit(10) + i % 7).alias("records"), (i % 2).alias("rejected"), (i * 3).alias("n_bytes"), i.alias("cursor_after"), F.col("ts"), F.col("k"))


OUTCOMES = f"""SELECT id AS deliverable_id, target_table AS pipeline, (['acked','retry_later','acked','partial_ack','permanent','acked','retry_later'])[id % 7 + 1] AS kind,
 CASE WHEN id % 3 = 0 THEN '' ELSE 'r' || (id % 4) END AS reason, id - 1 AS accepted_cursor, 10 + id % 7 AS records, id % 2 AS rejected, id * 3 AS n_bytes, id AS cursor_after, ts, e, k FROM ({QUEUE})"""


def deliverables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a k under 40 as waiting deliverables with k % 14 attempts."""
    return queue(spark, sf_dir).where("k < 40").select("id", F.col("target_table").alias("pipeline"), F.col("ts").alias("enqueued_at"), (F.col("k") % 14).cast("int").alias("attempts"), F.timestamp_seconds(F.unix_timestamp("ts") + (F.col("k") % 14) * 60).alias("next_attempt_at"), F.col("id").alias("cursor_after"))


DELIVERABLES = f"SELECT id, target_table AS pipeline, e AS enqueued_at, k % 14 AS attempts, e + (k % 14) * 60 AS next_attempt_at, id AS cursor_after FROM ({QUEUE}) WHERE k < 40"
