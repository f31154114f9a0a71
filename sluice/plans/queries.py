"""A query for each operator over the given tables, and the same rows in SQL."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import fields, geo, lines
from sluice.operators import bundles, chunk, claims, cycles, dedup, joins, predicates, state
from sluice.plans.inputs import DELIVERABLES, OUTCOMES, QUEUE, SPOTS, deliverables, outcomes, queue, spots, table
from sluice.sources import queue as source
from sluice.sources import spool, versions
from sluice.shared import cut, exists, scratch
from sluice.streaming import delivery, gate, retry, ride, tally
from sluice.types import QUEUE as QUEUE_SCHEMA

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
NOW_SQL, NOW_S = "TIMESTAMP '2024-01-20 12:30:00'", 1705753800
HOUR = 3600


def now() -> Column:
    """The time that queries take for the present."""
    return F.timestamp_seconds(F.lit(NOW_S))


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def seconds(df: DataFrame, *names: str) -> DataFrame:
    """Times as whole seconds, which every engine writes alike."""
    return df.withColumns({n: F.unix_timestamp(n) for n in names})


def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.quarantine(queue(spark, sf_dir))[0]


# ---- sources -------------------------------------------------------------------------------------------------------


@query(f"""WITH q AS ({QUEUE}), g AS (SELECT * FROM q WHERE schema_version IN (1, 2) AND k <> 5),
 r AS (SELECT id, day, user_id, value, row_number() OVER (PARTITION BY day, user_id ORDER BY value DESC NULLS LAST, id) rn, min(id) OVER (PARTITION BY day, user_id) first_id FROM g)
 SELECT id, day, user_id, value, first_id FROM r WHERE rn = 1 AND first_id > 200 ORDER BY first_id LIMIT 100""")
def owed_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best event of each day and user that no earlier slice has seen."""
    rows = predicates.payload_where(predicates.schema_gate(ready(spark, sf_dir), [1, 2]), [("k", "!=", 5)])
    return dedup.best_of(rows.select("id", "day", "user_id", "value"), ["day", "user_id"], "value", cursor=200, limit=100)


@query(f"SELECT id, target_table FROM ({QUEUE}) WHERE id > 500 ORDER BY id LIMIT 200")
def owed(spark, sf_dir):
    return source.owed(queue(spark, sf_dir), 500, 200).select("id", "target_table")


@query(f"SELECT id, station FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY id) rn FROM ({QUEUE}) WHERE id > station * 10) WHERE rn <= 7")
def owed_by_key(spark, sf_dir):
    rows = queue(spark, sf_dir)
    cursors = rows.select("station").distinct().withColumn("cursor", F.col("station") * 10)
    return source.owed(rows, cursors, 7, ("station",)).select("id", "station")


@query(f"SELECT target_table, max(id) AS cursor FROM ({QUEUE}) GROUP BY 1")
def slice_cursor(spark, sf_dir):
    return source.slice_cursor(queue(spark, sf_dir), ("target_table",))


@query(f"SELECT id, value FROM ({QUEUE}) WHERE target_table = 'click'")
def route(spark, sf_dir):
    return source.route(queue(spark, sf_dir), "main", "click").select("id", "value")


@query(f"SELECT coalesce(max(id), 0) AS cursor, 'now' AS start_at FROM ({QUEUE}) UNION ALL SELECT coalesce(max(id), 0), 'time' FROM ({QUEUE}) WHERE ts < {NOW_SQL} UNION ALL SELECT 0, 'beginning'")
def start_anchor(spark, sf_dir):
    rows = queue(spark, sf_dir)
    each = {"now": source.start_anchor(rows), "time": source.start_anchor(rows, now(), F.col("ts")), "beginning": source.start_anchor(rows, "beginning")}
    out = None
    for name, df in each.items():
        one = df.withColumn("start_at", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT id, (e // 120) * 120 - 120 AS start FROM ({QUEUE})")
def start_cycle(spark, sf_dir):
    return seconds(queue(spark, sf_dir).select("id", cycles.start_cycle(F.col("ts")).alias("start")), "start")


@query(f"SELECT id, target_table FROM ({QUEUE}) WHERE target_table = 'view' OR (target_table = 'click' AND id > 300) OR (target_table = 'error' AND id > 10) OR target_table NOT IN ('view', 'click', 'error')")
def retained(spark, sf_dir):
    cursors = spark.sql("SELECT * FROM VALUES ('click', 'a', 300L), ('click', 'b', 900L), ('error', 'a', 10L), ('view', 'a', -1L) AS t(target_table, dest_id, cursor)")
    return source.retained(queue(spark, sf_dir), cursors).select("id", "target_table")


@query(f"SELECT target_table, count(*) AS n_rows, count(*) FILTER (schema_version NOT IN (1, 2)) AS n_stale, max(queued_at) AS newest, CASE WHEN count(*) FILTER (schema_version NOT IN (1, 2)) > 0 THEN 'stale-schema' ELSE 'ok' END AS status FROM ({QUEUE}) GROUP BY 1")
def source_health(spark, sf_dir):
    return source.source_health(queue(spark, sf_dir), [1, 2])


# ---- predicates ----------------------------------------------------------------------------------------------------


@query(f"SELECT id, schema_version FROM ({QUEUE}) WHERE schema_version IN (1, 2)")
def schema_gate(spark, sf_dir):
    return predicates.schema_gate(queue(spark, sf_dir), [1, 2]).select("id", "schema_version")


@query(f"SELECT target_table, schema_version, count(*) AS n_rows FROM ({QUEUE}) WHERE schema_version NOT IN (1, 2) GROUP BY 1, 2")
def stale_schema(spark, sf_dir):
    return predicates.stale_schema(queue(spark, sf_dir), [1, 2], ("target_table",))


@query(f"SELECT id, k FROM ({QUEUE}) WHERE k >= 10 AND k < 60 AND k <> 33 AND k NOT IN (11, 12)")
def payload_where(spark, sf_dir):
    return predicates.payload_where(ready(spark, sf_dir), [("k", ">=", 10), ("k", "<", 60), ("k", "!=", 33), ("k", "NOT IN", [11, 12])]).select("id", "k")


@query(f"SELECT id FROM ({QUEUE}) WHERE ts <= (SELECT max(ts) FROM ({QUEUE}) WHERE k = 7 AND user_id < 50)")
def ceiling(spark, sf_dir):
    rows = queue(spark, sf_dir)
    return predicates.ceiling(rows, "ts", rows.where("k = 7 AND user_id < 50").agg(F.max("ts").alias("ts"))).select("id")


@query(f"SELECT id, CAST(k AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM ({QUEUE})")
def project_payload(spark, sf_dir):
    return predicates.project_payload(ready(spark, sf_dir), {"k": "long", "absent": "string"}, ["id"])


@query(f"SELECT id, CASE WHEN id % 3 = 0 THEN e + 60 WHEN id % 3 = 1 THEN e ELSE {NOW_S} END AS time FROM ({QUEUE})")
def record_time(spark, sf_dir):
    own = F.when(F.col("id") % 3 == 0, F.to_json(F.struct(F.date_format(F.timestamp_seconds(F.unix_timestamp("ts") + 60), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("decode_time")))).otherwise(F.lit('{"time": "soon"}'))
    rows = queue(spark, sf_dir).withColumns({"payload_json": own, "queued_at": F.when(F.col("id") % 3 == 2, "never").otherwise(F.col("queued_at"))})
    return seconds(predicates.with_record_time(predicates.quarantine(rows)[0], now()).select("id", "time"), "time")


@query(f"SELECT id, id % 7 <> 0 AS good FROM ({QUEUE})")
def quarantine(spark, sf_dir):
    rows = queue(spark, sf_dir).withColumn("payload_json", F.when(F.col("id") % 7 == 0, F.expr("left(payload_json, 4)")).otherwise(F.col("payload_json")))
    return predicates.read_payload(rows).select("id", F.col("payload").isNotNull().alias("good"))


@query(f"SELECT id, (target_table = 'click' AND schema_version = 1) OR (target_table = 'view' AND schema_version IN (1, 3)) AS accepted FROM ({QUEUE})")
def accepts(spark, sf_dir):
    accepted = spark.sql("SELECT * FROM VALUES ('click', 1), ('view', 1), ('view', 3) AS t(target_table, schema_version)")
    return predicates.with_accepted(queue(spark, sf_dir), accepted).select("id", "accepted")


@query(f"SELECT id, call FROM ({SPOTS}) WHERE call NOT IN ('', '<...>')")
def reportable(spark, sf_dir):
    return predicates.reportable(spots(spark, sf_dir)).select("id", "call")


@query(f"SELECT id, mode FROM ({SPOTS}) WHERE lower(mode) IN ('ft8', 'ft4', 'msk144')")
def supported_modes(spark, sf_dir):
    return predicates.supported_modes(spots(spark, sf_dir)).select("id", "mode")


@query(f"""SELECT id, nullif(CASE WHEN call = '' THEN 'X1X' ELSE call END, '') AS call, round(CASE WHEN id % 4 = 0 THEN mhz ELSE round(mhz * 1e6) / 1e6 END, 6) AS mhz, sync, snr, dt, power,
 CASE WHEN id % 2 = 0 THEN drift ELSE drift * 30 END AS drift, kind, grid, upper(mode) AS mode FROM ({SPOTS})""")
def normalize_spot(spark, sf_dir):
    s = spots(spark, sf_dir)
    old, mhz = F.col("id") % 2 == 0, F.col("id") % 4 == 0
    first = F.struct(F.col("call").alias("tx_sign"), F.lit("X1X").alias("callsign"), F.when(mhz, F.col("mhz")).alias("frequency_mhz"), F.lit(0).alias("frequency"), F.when(~mhz, F.round(F.col("mhz") * 1e6).cast("long")).alias("frequency_hz"), F.when(old, F.col("snr")).alias("snr"), F.when(~old, F.col("snr")).alias("snr_db"), F.col("sync").alias("sync_quality"), "dt", F.when(old, F.col("power")).alias("power"), F.when(~old, F.col("power")).alias("pwr_dbm"), F.when(old, F.col("drift")).alias("drift"), F.when(~old, F.col("drift") / 2).alias("drift_hz_per_s"), F.when(old, F.col("kind")).alias("code"), F.when(~old, F.col("kind")).alias("pkt_mode"), F.col("grid").alias("tx_loc"), "mode")
    out = predicates.normalize_spot(s.select("id", F.parse_json(F.to_json(first)).alias("payload")), keep=["id"])
    return out.withColumn("mhz", F.round("mhz", 6))


@query(f"""SELECT id, CASE WHEN call = '' THEN 'X1X' ELSE call END AS call, CAST(round(mhz * 1e6) AS BIGINT) AS hz, CASE WHEN id % 3 = 0 THEN CAST(snr AS INT) WHEN id % 3 = 1 THEN CAST(k AS INT) ELSE -128 END AS snr, upper(mode) AS mode, grid AS locator,
 CASE WHEN id % 2 = 0 THEN 'AABB' ELSE '' END AS message FROM ({SPOTS})""")
def normalize_digital(spark, sf_dir):
    s, i = spots(spark, sf_dir), F.col("id")
    payload = F.struct(F.col("call").alias("tx_call"), F.lit("X1X").alias("callsign"), F.round(F.col("mhz") * 1e6).cast("long").alias("frequency"), F.when(i % 3 == 0, F.col("snr")).alias("snr_db"), F.when(i % 3 == 1, F.col("k")).alias("score"), "mode", "grid", F.when(i % 2 == 0, "aabb").alias("message_bytes"))
    return predicates.normalize_digital(s.select("id", F.parse_json(F.to_json(payload)).alias("payload")), keep=["id"]).withColumn("message", F.hex("message"))


@query(f"SELECT id, CASE WHEN id % 3 = 0 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS whole, CASE WHEN id % 3 = 0 THEN 0.0 ELSE value END AS number FROM ({QUEUE})")
def lenient(spark, sf_dir):
    text = F.when(F.col("id") % 3 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return queue(spark, sf_dir).select("id", fields.lenient_int(text).alias("whole"), fields.lenient_double(text).alias("number"))


# ---- joins ---------------------------------------------------------------------------------------------------------

_SUBSCRIBED = "('click', 'a', 300L), ('click', 'b', 0L), ('view', 'a', 100L), ('none', 'c', 0L)"


@query(f"""SELECT id, target_table, dest_id FROM ({QUEUE}) JOIN (VALUES ('click', 'a', 300), ('click', 'b', 0), ('view', 'a', 100)) t(target_table, dest_id, cursor) USING (target_table) WHERE id > cursor""")
def owed_by_destination(spark, sf_dir):
    known = spark.sql(f"SELECT * FROM VALUES {_SUBSCRIBED} AS t(target_table, dest_id, cursor)")
    return joins.owed_by_destination(queue(spark, sf_dir), known.drop("cursor"), known.where("cursor > 0")).select("id", "target_table", "dest_id")


@query(f"WITH q AS ({QUEUE}) SELECT s.id, (s.e // 120) * 120 AS cycle FROM q s WHERE target_table = 'view' AND (s.e // 120) IN (SELECT e // 120 FROM q WHERE target_table = 'click')")
def ride_along(spark, sf_dir):
    rows = queue(spark, sf_dir)
    clicks = rows.where("target_table = 'click'").select(fields.cycle_floor(F.col("ts")).alias("cycle"))
    return seconds(joins.ride_along(clicks, rows.where("target_table = 'view'").select("id", "ts"), "ts").select("id", "cycle"), "cycle")


@query(f"WITH q AS ({QUEUE}) SELECT c.id AS cycle_id, s.id FROM q c JOIN q s ON s.ts >= c.ts AND s.e - c.e < 120 WHERE c.target_table = 'click' AND s.target_table = 'view'")
def ride_along_off_grid(spark, sf_dir):
    rows = queue(spark, sf_dir)
    starts = rows.where("target_table = 'click'").select(F.col("id").alias("cycle_id"), F.col("ts").alias("start"))
    return joins.ride_along_off_grid(starts, rows.where("target_table = 'view'").select("id", "ts"), "ts").select("cycle_id", "id")


_HOURS = f"SELECT DISTINCT e // {HOUR} * {HOUR} AS cycle, reporter FROM ({QUEUE})"


def _hours(spark, sf_dir):
    return queue(spark, sf_dir).select(fields.cycle_floor(F.col("ts"), HOUR).alias("cycle"), "reporter", "station", "ts")


@query(f"WITH s AS ({_HOURS}) SELECT c.cycle, r.reporter FROM (SELECT DISTINCT cycle FROM s) c CROSS JOIN (VALUES ('0'), ('1'), ('2'), ('3'), ('4')) r(reporter) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cycle = c.cycle AND s.reporter = r.reporter)")
def missing_reporters(spark, sf_dir):
    return seconds(joins.missing_reporters(_hours(spark, sf_dir), ["0", "1", " 2", "3", "4"]), "cycle")


@query(f"SELECT id, target_table AS pipeline FROM ({QUEUE}) WHERE target_table NOT IN (SELECT pipeline FROM ({DELIVERABLES}) WHERE pipeline IN ('click', 'error'))")
def drain_gate(spark, sf_dir):
    owed_ = queue(spark, sf_dir).select("id", F.col("target_table").alias("pipeline"))
    return joins.drain_gate(owed_, deliverables(spark, sf_dir).where("pipeline IN ('click', 'error')")).select("id", "pipeline")


@query(f"SELECT id, CASE target_table WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 9999 END AS code FROM ({QUEUE})")
def lookup(spark, sf_dir):
    dimension = spark.sql("SELECT * FROM VALUES ('click', 1), ('view', 2) AS t(target_table, code)")
    return joins.lookup(queue(spark, sf_dir), dimension, ["target_table"], "code", F.lit(9999)).select("id", "code")


@query(f"""SELECT target_table, CASE WHEN target_table NOT IN ('click', 'view') THEN 'no subscription' ELSE 'before start' END AS why, count(*) AS n_rows FROM ({QUEUE})
 WHERE target_table NOT IN ('click', 'view') OR (target_table = 'click' AND id <= 200) GROUP BY 1, 2""")
def orphans(spark, sf_dir):
    subscriptions = spark.sql("SELECT * FROM VALUES ('click', 'a'), ('click', 'b'), ('view', 'a') AS t(target_table, dest_id)")
    anchors = spark.sql("SELECT * FROM VALUES ('click', 'a', 500L), ('click', 'b', 200L), ('view', 'a', -1L) AS t(target_table, dest_id, cursor)")
    return joins.orphans(queue(spark, sf_dir), subscriptions, anchors)


# ---- cycles --------------------------------------------------------------------------------------------------------


@query(f"SELECT id, e // 120 * 120 AS cycle, (e - 20) // 120 * 120 AS buffered FROM ({QUEUE})")
def cycle_floor(spark, sf_dir):
    return seconds(queue(spark, sf_dir).select("id", fields.cycle_floor(F.col("ts")).alias("cycle"), fields.cycle_floor(F.col("ts"), buffer=20).alias("buffered")), "cycle", "buffered")


@query(f"SELECT DISTINCT e // 120 * 120 AS cycle FROM ({QUEUE}) WHERE e // 120 * 120 > {NOW_S - 86400} AND e < {NOW_S}")
def closed_cycles(spark, sf_dir):
    return seconds(cycles.closed_cycles(queue(spark, sf_dir), now(), now() - F.expr("interval 1 day"), time="ts"), "cycle")


@query(f"SELECT cycle, count(DISTINCT reporter) FILTER (reporter <> '4') AS n_seen, count(DISTINCT reporter) FILTER (reporter <> '4') = 4 AS complete FROM ({_HOURS}) GROUP BY 1")
def cycle_complete(spark, sf_dir):
    return seconds(cycles.cycle_complete(_hours(spark, sf_dir), ["0", "1", "2", "3"]), "cycle")


@query(f"""WITH s AS (SELECT DISTINCT station, e // 86400 * 86400 AS cycle, reporter FROM ({QUEUE})), w AS (SELECT DISTINCT station, reporter FROM s WHERE cycle % (86400 * 2) = 0)
 SELECT s.station, s.cycle, count(w.reporter) AS n_seen, count(w.reporter) >= coalesce(any_value(n), 0) AS complete FROM s LEFT JOIN w USING (station, reporter) LEFT JOIN (SELECT station, count(*) n FROM w GROUP BY 1) USING (station) GROUP BY 1, 2""")
def cycle_complete_by_station(spark, sf_dir):
    days = queue(spark, sf_dir).select("station", fields.cycle_floor(F.col("ts"), 86400).alias("cycle"), "reporter")
    expected = days.where(F.unix_timestamp("cycle") % (86400 * 2) == 0).select("station", "reporter").distinct()
    return seconds(cycles.cycle_complete(days, expected, ("station",)), "cycle")


@query(f"SELECT DISTINCT cycle, cycle < {NOW_S} - ({HOUR} + 90) AS past FROM ({_HOURS})")
def past_backstop(spark, sf_dir):
    return seconds(_hours(spark, sf_dir).select("cycle", fields.past_backstop(F.col("cycle"), now(), 90, HOUR).alias("past")).distinct(), "cycle")


_COMPLETE = f"SELECT station, e // {HOUR} * {HOUR} AS cycle, count(DISTINCT user_id % 3) = 3 AS complete FROM ({QUEUE}) GROUP BY 1, 2"


def _complete(spark, sf_dir):
    rows = queue(spark, sf_dir).select("station", fields.cycle_floor(F.col("ts"), HOUR).alias("cycle"), (F.col("user_id") % 3).cast("string").alias("reporter"))
    return cycles.cycle_complete(rows, ["0", "1", "2"], ("station",))


@query(f"""WITH c AS ({_COMPLETE}), d AS (SELECT *, complete OR cycle < {NOW_S} - ({HOUR} + 36000) AS ready FROM c WHERE cycle < {NOW_S // HOUR * HOUR}), b AS (SELECT station, min(cycle) FILTER (NOT ready) AS bad FROM d GROUP BY 1)
 SELECT station, max(cycle) AS ceiling FROM d JOIN b USING (station) WHERE bad IS NULL OR cycle < bad GROUP BY 1""")
def shippable_ceiling(spark, sf_dir):
    return seconds(cycles.shippable_ceiling(_complete(spark, sf_dir), now(), 36000, ("station",), seconds=HOUR), "ceiling")


@query(f"""WITH q AS (SELECT *, e // 120 * 120 AS cycle FROM ({QUEUE})), b AS (SELECT id, cycle, CASE target_table WHEN 'click' THEN 'spots' ELSE 'noise' END AS part FROM q WHERE target_table IN ('click', 'view'))
 SELECT * FROM b UNION ALL SELECT id, cycle, 'side' FROM q WHERE target_table = 'error' AND cycle IN (SELECT cycle FROM b)""")
def cycle_bundle(spark, sf_dir):
    return seconds(_bundle(spark, sf_dir).select("id", "cycle", "part"), "cycle")


def _bundle(spark, sf_dir):
    rows = queue(spark, sf_dir).select("id", "ts", "target_table")
    part = lambda name: rows.where(F.col("target_table") == name).drop("target_table")
    return cycles.cycle_bundle(part("click"), part("view"), part("error"), time="ts", how="inner")


@query(f"""SELECT e // 120 * 120 AS cycle, count(*) FILTER (target_table = 'click') AS n_spots, count(*) FILTER (target_table = 'view') AS n_noise,
 CASE WHEN count(*) FILTER (target_table = 'view') = 0 THEN 'spots-only' WHEN count(*) FILTER (target_table = 'click') = 0 THEN 'noise-only' ELSE 'both' END AS balance FROM ({QUEUE}) WHERE target_table IN ('click', 'view') GROUP BY 1""")
def cycle_balance(spark, sf_dir):
    return seconds(cycles.cycle_balance(_bundle(spark, sf_dir)), "cycle")


@query(f"""WITH c AS ({_COMPLETE}), s AS (SELECT DISTINCT station, e // {HOUR} * {HOUR} AS cycle, user_id % 3 AS r FROM ({QUEUE})),
 f AS (SELECT station, cycle FROM c WHERE NOT complete AND cycle < {NOW_S} - ({HOUR} + 90) AND NOT (station = 3 AND cycle % {2 * HOUR} = 0))
 SELECT f.station, f.cycle, string_agg(CAST(x.r AS VARCHAR), ',' ORDER BY x.r) AS missing FROM f CROSS JOIN (VALUES (0), (1), (2)) x(r) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.station = f.station AND s.cycle = f.cycle AND s.r = x.r) GROUP BY 1, 2""")
def backstop_alerts(spark, sf_dir):
    done = _complete(spark, sf_dir)
    present = queue(spark, sf_dir).select("station", fields.cycle_floor(F.col("ts"), HOUR).alias("cycle"), (F.col("user_id") % 3).cast("string").alias("reporter"))
    missing = joins.missing_reporters(present, ["0", "1", "2"], ("station",))
    alerted = done.where((F.col("station") == 3) & (F.unix_timestamp("cycle") % (2 * HOUR) == 0)).select("station", "cycle")
    return seconds(cycles.backstop_alerts(done, missing, alerted, now(), 90, ("station",), seconds=HOUR), "cycle")


@query(f"SELECT id, station FROM ({QUEUE}) WHERE e // 120 * 120 <= {NOW_S // 120 * 120} - station * 86400")
def late_rows(spark, sf_dir):
    rows = queue(spark, sf_dir)
    passed = rows.select("station").distinct().withColumn("cycle", F.timestamp_seconds(F.lit(NOW_S // 120 * 120) - F.col("station") * 86400))
    return cycles.late_rows(rows, passed, ("station",), "ts").select("id", "station")


# ---- one of many, and bundles --------------------------------------------------------------------------------------


@query(f"""WITH r AS (SELECT id, day, user_id, value, row_number() OVER (PARTITION BY day, user_id ORDER BY value DESC NULLS LAST, id) rn, min(id) OVER (PARTITION BY day, user_id) first_id FROM ({QUEUE}))
 SELECT id, day, user_id, value, first_id FROM r WHERE rn = 1 AND first_id > 200 ORDER BY id LIMIT 150""")
def best_of_compat(spark, sf_dir):
    return dedup.best_of(queue(spark, sf_dir).select("id", "day", "user_id", "value"), ["day", "user_id"], "value", 200, 150, compat=True)


@query(f"""SELECT id, day, user_id, value, first_id FROM (SELECT id, day, user_id, value, row_number() OVER (PARTITION BY day, user_id ORDER BY value DESC NULLS LAST, id) rn, min(id) OVER (PARTITION BY day, user_id) first_id FROM ({QUEUE})) WHERE rn = 1""")
def best_of_window(spark, sf_dir):
    return dedup.best_of_window(queue(spark, sf_dir).select("id", "day", "user_id", "value"), ["day", "user_id"], "value", -1)


_BEST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, e // 60, call, round_even(mhz, 4) ORDER BY snr DESC, id) rn FROM (SELECT * REPLACE (e // {HOUR} * {HOUR} AS e) FROM ({SPOTS})) WHERE call <> '') WHERE rn = 1"""


def _batch(spark, sf_dir):
    """Spots with their times set to the hour, so that batches have duplicates."""
    return spots(spark, sf_dir).withColumn("ts", fields.cycle_floor(F.col("ts"), HOUR))


@query(f"SELECT id, call, snr FROM ({_BEST}) UNION ALL SELECT id, call, snr FROM ({SPOTS}) WHERE call = ''")
def best_spot(spark, sf_dir):
    return dedup.best_spot(_batch(spark, sf_dir), ("station",), "ts", pos="id").select("id", "call", "snr")


@query(f"SELECT max(id) AS id, user_id % 4 AS receiver, k % 5 AS band, e // {HOUR} AS cycle FROM ({QUEUE}) GROUP BY 2, 3, 4")
def noise_last_wins(spark, sf_dir):
    rows = queue(spark, sf_dir).select("id", (F.col("user_id") % 4).alias("receiver"), (F.col("k") % 5).alias("band"), F.floor(F.unix_timestamp("ts") / HOUR).alias("cycle"))
    return dedup.noise_last_wins(rows)


_LABELLED = f"""SELECT *, replace(rx_call, '/', '=') || CASE WHEN rx_grid = '' THEN '' ELSE '_' || rx_grid END AS rx_site, CASE WHEN radiod_id IS NULL THEN 'rx' ELSE replace(replace(radiod_id, 'radiod:', ''), '-status.local', '') END AS receiver,
 CASE WHEN mhz BETWEEN 1.8 AND 2.0 THEN 160 WHEN mhz BETWEEN 3.5 AND 4.0 THEN 80 WHEN mhz BETWEEN 7.0 AND 7.3 THEN 40 WHEN mhz BETWEEN 14.0 AND 14.35 THEN 20 WHEN mhz BETWEEN 28.0 AND 29.7 THEN 10 WHEN mhz BETWEEN 50.0 AND 54.0 THEN 6 ELSE 9999 END AS band FROM ({SPOTS})"""


def _labelled(spark, sf_dir):
    return bundles.label_receivers(_batch(spark, sf_dir)).withColumn("band", geo.band_of(F.col("mhz")))


@query(f"SELECT id, rx_site, receiver, band FROM ({_LABELLED})")
def label_receivers(spark, sf_dir):
    return _labelled(spark, sf_dir).select("id", "rx_site", "receiver", "band")


@query(f"""WITH l AS (SELECT *, make_timestamp((e // {HOUR}) * {HOUR} * 1000000) AS t FROM ({_LABELLED}))
 SELECT 'spots/' || rx_site || '/' || receiver || '/' || band || '/' || receiver || '_' || band || '_' || mode || '_' || strftime(t, '%Y%m%d_%H%M%S') || CASE WHEN mode LIKE 'W%' THEN '_wd_spots.txt' ELSE '_spots.txt' END AS arcname,
 count(*) AS n_lines, string_agg(call || ' ' || id, chr(10) ORDER BY id) || chr(10) AS content FROM l GROUP BY rx_site, receiver, band, mode, t""")
def bundle_spots(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("line", F.concat_ws(" ", "call", F.col("id").cast("string")))
    return bundles.bundle_spots(rows, "ts")


@query(f"""WITH l AS (SELECT *, make_timestamp((e // {HOUR}) * {HOUR} * 1000000) AS t, CAST(round(mhz * 1e6) AS BIGINT) AS frequency FROM ({_LABELLED}) WHERE lower(mode) IN ('ft8', 'ft4', 'msk144'))
 SELECT lower(mode) || '/' || rx_site || '/' || receiver || '/' || band || '/' || strftime(t, '%y%m%d_%H%M') || '_' || lower(mode) || '.jsonl' AS arcname, count(*) AS n_lines,
 string_agg('{{"call":"' || call || '","frequency":' || frequency || ',"id":' || id || '}}', chr(10) ORDER BY t, frequency, call, id) || chr(10) AS content FROM l GROUP BY lower(mode), rx_site, receiver, band, t""")
def bundle_digital(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("frequency", F.round(F.col("mhz") * 1e6).cast("long"))
    return bundles.bundle_digital(rows, ["id", "call", "frequency"], "ts", order=("call", "id"))


@query(f"""WITH l AS (SELECT *, make_timestamp((e // {HOUR}) * {HOUR} * 1000000) AS t, row_number() OVER (PARTITION BY rx_site, receiver, band, e // {HOUR} ORDER BY id DESC) rn FROM ({_LABELLED}))
 SELECT 'noise/' || rx_site || '/' || receiver || '/' || band || '/' || receiver || '_' || band || '_' || strftime(t, '%Y%m%d_%H%M%S') || '_noise.txt' AS arcname,
 repeat(' 0.00 ', 0) || printf('%5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %d', 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, -value, CASE WHEN id % 3 = 0 THEN 0.0 ELSE -value / 2 END, k) || chr(10) AS content FROM l WHERE rn = 1""")
def bundle_noise(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumns({"rms_noise_dbm": -F.col("value"), "fft_noise_dbm": F.when(F.col("id") % 3 != 0, -F.col("value") / 2), "overload_count": F.col("k")})
    return bundles.bundle_noise(rows, "ts")


@query(f"""WITH e AS (SELECT station, rx_site || '/' || receiver AS r, bool_and(k > 2) AS f FROM ({_LABELLED}) GROUP BY 1, 2), d AS (SELECT station, 2 * count(*) FILTER (f) >= count(*) AS default_flag FROM e GROUP BY 1)
 SELECT station, default_flag, '{{' || coalesce(string_agg('"' || r || '":' || f, ',' ORDER BY r) FILTER (f <> default_flag), '') || '}}' AS overrides FROM e JOIN d USING (station) GROUP BY 1, 2""")
def routing_flags(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("forward", F.when(F.col("k") > 50, None).otherwise(F.col("k") > 2))
    return bundles.routing_flags(rows, ("station",))


_LINE = """CASE WHEN mode LIKE 'W%' THEN printf('%-6s %4s %5.2f %3d %5.2f %12.7f %-14s %-6s %2d %2d %4d', strftime(t, '%y%m%d'), strftime(t, '%H%M'), sync, CAST(snr AS BIGINT), dt, mhz, call, grid, power, drift, kind)
 ELSE printf('%-6s %4s %5.1f %3.0f %5.2f %12.7f %-14s %-6s %2d  0 %4d', strftime(t, '%y%m%d'), strftime(t, '%H%M'), sync, snr, dt, mhz, call, grid, power, kind) END"""


@query(f"SELECT id, {_LINE} AS line FROM (SELECT *, make_timestamp(e * 1000000) AS t FROM ({SPOTS})) WHERE call NOT IN ('', '<...>')")
def render_lines(spark, sf_dir):
    return bundles.render_lines(spots(spark, sf_dir), "ts").select("id", "line")


_BODIES = f"""SELECT *, row_number() OVER (PARTITION BY station, batch_id, e // 60, call, round_even(mhz, 4) ORDER BY snr DESC, id) rn
 FROM (SELECT * REPLACE (e // {HOUR} * {HOUR} AS e), (row_number() OVER (PARTITION BY station ORDER BY id) - 1) // 999 AS batch_id FROM ({SPOTS})) WHERE call <> ''"""


@query(f"""SELECT station, batch_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY e, mhz, line) AS body FROM (SELECT *, {_LINE} AS line FROM (SELECT *, make_timestamp(e * 1000000) AS t FROM ({_BODIES}) WHERE rn = 1) WHERE call <> '<...>') GROUP BY 1, 2""")
def report_body(spark, sf_dir):
    """Bodies of up to 999 rows each, by station."""
    rows = chunk.chunk_by_count(_batch(spark, sf_dir).withColumnRenamed("id", "pos"), 999, ("pos",), ("station",))
    return bundles.report_body(rows, ("station", "batch_id"), "ts")


@query(f"SELECT station, strftime(make_timestamp(e * 1000000), '%H:%M') AS hhmm, count(*) AS n_spots FROM (SELECT station, e FROM ({_BEST}) UNION ALL SELECT station, e // {HOUR} * {HOUR} FROM ({SPOTS}) WHERE call = '') GROUP BY 1, 2")
def cycle_counts(spark, sf_dir):
    return bundles.cycle_counts(_batch(spark, sf_dir).withColumnRenamed("id", "pos"), "ts", ("station",))


@query(f"SELECT reporter AS pipeline, mode, CAST(kind AS VARCHAR) AS outcome, count(*) AS n_rows FROM ({SPOTS}) GROUP BY 1, 2, 3")
def mode_counts(spark, sf_dir):
    return bundles.mode_counts(spots(spark, sf_dir).select(F.col("reporter").alias("pipeline"), "mode", F.col("kind").cast("string").alias("outcome")))


@query(f"SELECT station AS dest_id, day, sum(CASE WHEN id % 5 <> 0 THEN k % 7 END) AS n_added, sum(CASE WHEN id % 5 <> 0 THEN k % 7 + id % 3 END) AS n_sent, CASE WHEN sum(CASE WHEN id % 5 <> 0 THEN k % 7 + id % 3 END) <> 0 THEN sum(CASE WHEN id % 5 <> 0 THEN k % 7 END)::DOUBLE / sum(CASE WHEN id % 5 <> 0 THEN k % 7 + id % 3 END) END AS rate FROM ({QUEUE}) GROUP BY 1, 2")
def acceptance_rate(spark, sf_dir):
    text = F.when(F.col("id") % 5 == 0, "error").otherwise(F.concat((F.col("k") % 7).cast("string"), F.lit(" out of "), (F.col("k") % 7 + F.col("id") % 3).cast("string"), F.lit(" spot(s) added")))
    return bundles.acceptance_rate(queue(spark, sf_dir).select(F.col("station").alias("dest_id"), "day", text.alias("response")))


def _results(spark, sf_dir):
    i = F.col("id")
    reasons = F.when(i % 2 == 0, F.array(F.struct(F.lit("dup").alias("reason"), (i % 3).alias("count")), F.struct(F.lit("late").alias("reason"), F.lit(None).cast("long").alias("count"))))
    said = F.to_json(F.struct(F.when(i % 5 == 0, "failed").otherwise("done").alias("status"), F.col("k").alias("accepted"), (F.col("k") + i % 3).alias("submitted"), reasons.alias("rejections")))
    return bundles.submission_results(queue(spark, sf_dir).select(F.col("station").alias("dest_id"), F.when(i % 17 == 0, "oops").otherwise(said).alias("response")))


@query(f"SELECT station AS dest_id, CASE WHEN id % 17 = 0 OR id % 5 = 0 THEN 'failed' ELSE 'done' END AS status, count(*) AS n_messages, sum(CASE WHEN id % 17 <> 0 THEN k END) AS n_accepted, sum(CASE WHEN id % 17 <> 0 THEN k + id % 3 END) AS n_submitted FROM ({QUEUE}) GROUP BY 1, 2")
def submission_results(spark, sf_dir):
    return _results(spark, sf_dir)[0]


@query(f"SELECT station AS dest_id, reason, sum(n) AS n_rejected FROM (SELECT station, 'dup' AS reason, id % 3 AS n FROM ({QUEUE}) WHERE id % 2 = 0 AND id % 17 <> 0 UNION ALL SELECT station, 'late', 1 FROM ({QUEUE}) WHERE id % 2 = 0 AND id % 17 <> 0) GROUP BY 1, 2")
def rejections(spark, sf_dir):
    return _results(spark, sf_dir)[1]


# ---- expressions ---------------------------------------------------------------------------------------------------


def _grid(g: str) -> tuple[str, str]:
    c = lambda i: f"ascii(substr({g}, {i}, 1))"
    lat = f"CASE WHEN length({g}) >= 4 THEN ({c(2)} - 65) * 10.0::DOUBLE + ({c(4)} - 48) - 90 + CASE WHEN length({g}) = 6 THEN ({c(6)} - 65 + 0.5::DOUBLE) / 24 ELSE 0.5::DOUBLE END END"
    lon = f"CASE WHEN length({g}) >= 4 THEN ({c(1)} - 65) * 20.0::DOUBLE + ({c(3)} - 48) * 2 - 180 + CASE WHEN length({g}) = 6 THEN ({c(5)} - 65 + 0.5::DOUBLE) / 12 ELSE 1.0::DOUBLE END END"
    return lat, lon


_TX, _RX = _grid("grid"), _grid("upper(rx_grid)")
_PATHS = f"""WITH g AS (SELECT *, {_TX[0]} AS tx_lat, {_TX[1]} AS tx_lon, {_RX[0]} AS rx_lat, {_RX[1]} AS rx_lon FROM ({_LABELLED})),
 r AS (SELECT *, radians(tx_lat) p, radians(rx_lat) q, radians(tx_lon - rx_lon) d FROM g),
 a AS (SELECT *, CASE WHEN h IS NOT NULL THEN 2 * atan2(sqrt(h), sqrt(greatest(0, 1 - h))) END AS angle FROM (SELECT *, pow(sin((p - q) / 2), 2) + cos(q) * cos(p) * pow(sin(d / 2), 2) AS h FROM r))"""


@query(f"""{_PATHS} SELECT id, band, round(6371.0 * angle, 4) AS km, round((degrees(atan2(sin(d) * cos(p), cos(q) * sin(p) - sin(q) * cos(p) * cos(d))) + 360) % 360, 4) AS rx_az,
 round((degrees(atan2(sin(-d) * cos(q), cos(p) * sin(q) - sin(p) * cos(q) * cos(d))) + 360) % 360, 4) AS tx_az, round(CASE WHEN rx_lat IS NOT NULL THEN tx_lat END, 6) AS tx_lat, round(CASE WHEN tx_lat IS NOT NULL THEN rx_lon END, 6) AS rx_lon, round((tx_lon + rx_lon) / 2, 6) AS v_lon,
 round(degrees(CASE WHEN angle IS NULL THEN NULL WHEN angle > 1e-9 THEN acos(least(1, cos(q) * cos(p) * abs(sin(d / 2)) / sin(angle / 2))) ELSE q END) * CASE WHEN tx_lat > rx_lat THEN 1 ELSE -1 END, 4) AS v_lat FROM a""")
def enrich_paths(spark, sf_dir):
    rows = bundles.label_receivers(spots(spark, sf_dir))
    receivers = rows.select("user_id", "rx_grid").distinct()
    out = bundles.enrich_paths(rows, receivers, ("user_id",))
    return out.select("id", "band", *[F.round(n, 4).alias(n) for n in ("km", "rx_az", "tx_az")], *[F.round(n, 6).alias(n) for n in ("tx_lat", "rx_lon", "v_lon")], F.round("v_lat", 4).alias("v_lat"))


_EXTENDED = ", ".join(
    ["strftime(t, '%y%m%d')", "strftime(t, '%H%M')", "sync", "snr", "dt", "mhz", "call", "CASE WHEN grid = '' THEN 'none' ELSE grid END", "power", "drift", "k % 7", "k % 5", "k % 3", "CAST(round_even(k / 64.0::DOUBLE * 1000, 0) AS BIGINT)", "0", "1", "2", "kind", "0.0::DOUBLE", "0.0::DOUBLE", "band", "rx_grid", "rx_call"]
    + ["CAST(coalesce(round_even(6371.0 * angle, 0), -999) AS BIGINT)"]
    + [f"coalesce(CASE WHEN angle IS NOT NULL THEN {x} END, -999.0::DOUBLE)" for x in ("(degrees(atan2(sin(d) * cos(p), cos(q) * sin(p) - sin(q) * cos(p) * cos(d))) + 360) % 360", "rx_lat", "rx_lon", "(degrees(atan2(sin(-d) * cos(q), cos(p) * sin(q) - sin(p) * cos(q) * cos(d))) + 360) % 360", "tx_lat", "tx_lon", "degrees(CASE WHEN angle > 1e-9 THEN acos(least(1, cos(q) * cos(p) * abs(sin(d / 2)) / sin(angle / 2))) ELSE q END) * CASE WHEN tx_lat > rx_lat THEN 1 ELSE -1 END", "(tx_lon + rx_lon) / 2")]
    + ["0", "0"]
)


@query(f"{_PATHS} SELECT id, printf('{lines.EXTENDED}', {_EXTENDED}) AS line FROM (SELECT *, make_timestamp(e * 1000000) AS t FROM a)")
def extended_lines(spark, sf_dir):
    rows = bundles.label_receivers(spots(spark, sf_dir))
    k = F.col("k")
    rows = rows.withColumns({"cycles": k % 7, "jitter": k % 5, "blocksize": k % 3, "metric": k / 64, "decodetype": F.lit(0), "ipass": F.lit(1), "nhardmin": F.lit(2)})
    return bundles.extended_lines(bundles.enrich_paths(rows, rows.select("user_id", "rx_grid").distinct(), ("user_id",)), "ts").select("id", "line")


@query(f"SELECT id, band, CASE CAST(floor(10 * mhz) AS INT) WHEN 18 THEN 160 WHEN 35 THEN 80 WHEN 70 THEN 40 WHEN 140 THEN 20 WHEN 281 THEN 10 WHEN 502 THEN 6 ELSE 9999 END AS by_key FROM ({_LABELLED})")
def band_of(spark, sf_dir):
    return spots(spark, sf_dir).select("id", geo.band_of(F.col("mhz")).alias("band"), geo.band_of(F.col("mhz"), compat=True).alias("by_key"))


@query(f"SELECT id, strftime(ts, '%y%m%d') AS date, strftime(ts, '%H%M') AS hhmm, strftime(ts, '%Y%m%d_%H%M%S') AS file_ts, strftime(ts, '%y%m%d_%H%M') AS cycle_ts FROM ({QUEUE})")
def time_parts(spark, sf_dir):
    return queue(spark, sf_dir).select("id", *[c.alias(n) for n, c in fields.time_parts(F.col("ts")).items()])


@query(f"SELECT id, greatest(-128, least(127, coalesce(CASE WHEN id % 5 <> 0 THEN CAST(trunc(value * 10 - 300) AS INT) END, -128))) AS snr FROM ({QUEUE})")
def clamp_snr(spark, sf_dir):
    return queue(spark, sf_dir).select("id", fields.clamp_snr(F.when(F.col("id") % 5 != 0, F.col("value") * 10 - 300)).alias("snr"))


@query(f"""SELECT id, CASE WHEN id % 3 = 0 THEN 'spool/noise/S/R' || (user_id % 4) || '/14M/' || strftime(ts, '%y%m%d_%H%M') || '_noise.txt' WHEN id % 3 = 1 THEN 'spool/spots/S/R' || (user_id % 4) || '/14M/' || strftime(ts, '%y%m%d_%H%M') || '_spots.txt' ELSE 'spool/x' || id || '.txt' END AS arcname FROM ({QUEUE})""")
def layout_files(spark, sf_dir):
    base = F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string"), F.lit("/14M/"))
    rel = F.when(F.col("id") % 3 == 0, F.concat(base, F.lit("noise/"), F.date_format("ts", "yyyyMMdd_HHmm"), F.lit("00_noise.txt"))).when(F.col("id") % 3 == 1, F.concat(base, F.date_format("ts", "yyMMdd_HHmm"), F.lit("_spots.txt"))).otherwise(F.concat(F.lit("x"), F.col("id").cast("string"), F.lit(".txt")))
    return spool.layout_files(queue(spark, sf_dir).select("id", rel.alias("rel")), F.lit("S")).select("id", "arcname")


_FILES = f"SELECT 'OBS' || day AS dataset, 'ch' || (user_id % 3) || '/' || id AS file, k, e FROM ({QUEUE})"


def _files(spark, sf_dir):
    rel = F.concat(F.lit("OBS"), F.col("day"), F.lit("/ch"), (F.col("user_id") % 3).cast("string"), F.lit("/"), F.col("id").cast("string"))
    return queue(spark, sf_dir).select(rel.alias("rel"), F.col("k").alias("length"), F.col("ts").alias("mtime"))


@query(f"SELECT dataset, count(*) AS n_files, sum(k) AS n_bytes, max(e) AS mtime FROM ({_FILES}) GROUP BY 1")
def datasets(spark, sf_dir):
    return seconds(spool.datasets(_files(spark, sf_dir)), "mtime")


@query(f"SELECT dataset, part, count(*) AS n_files, sum(k) AS n_bytes, string_agg(file, ',' ORDER BY file) AS files FROM (SELECT *, (row_number() OVER (PARTITION BY dataset ORDER BY file) - 1) // 100 AS part FROM ({_FILES})) GROUP BY 1, 2")
def dataset_manifest(spark, sf_dir):
    return spool.dataset_manifest(_files(spark, sf_dir), part=100).withColumn("files", F.array_join("files", ","))


# ---- files in the shared folder ------------------------------------------------------------------------------------


def _queue_files(spark, sf_dir, fmt: str) -> str:
    at = f"{scratch(spark)}/queue"
    queue(spark, sf_dir).select(*[f.name for f in QUEUE_SCHEMA.fields]).write.format(fmt).save(at)
    return at


@query(f"SELECT id, 'main' AS target_db, target_table, schema_version, payload_json, queued_at FROM ({QUEUE})")
def read_queue(spark, sf_dir):
    """Events written as a queue in JSON and read back with the fixed schema."""
    return source.read_queue(spark, _queue_files(spark, sf_dir, "json"), "json")


@query(f"SELECT id, target_table FROM ({QUEUE}) WHERE target_table = 'click'")
def stream_queue(spark, sf_dir):
    """The same rows as a stream of files that is drained, routed and written back."""
    out = scratch(spark)
    stream = source.route(source.stream_queue(spark, _queue_files(spark, sf_dir, "parquet"), files_per_trigger=2), "main", "click").select("id", "target_table")
    delivery.drain(stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress"))
    return spark.read.schema("id long, target_table string").parquet(f"{out}/rows")


_SPOOL_SPECS = [spool.FileSpec("**/kind=click/**", "clicks"), spool.FileSpec("**/kind=view/**", "views"), spool.FileSpec("**/kind=error/**", "bad")]


def _spool(spark, sf_dir) -> str:
    """Events as text files, one for each kind and day; what isn't click, view or error has no spec."""
    at = f"{scratch(spark)}/spool"
    rows = queue(spark, sf_dir).select(F.col("target_table").alias("kind"), "day", F.concat_ws(",", F.col("id").cast("string"), "queued_at").alias("line"))
    spool.write_bundles(rows, at, ("kind", "day"))
    return at


def _click_lines(path: str, content: bytes) -> Iterator[dict]:
    for line in io.BytesIO(content):
        yield dict(zip(("id", "time"), line.decode().rstrip("\n").split(","), strict=True))


def _view_line(path: str, content: bytes) -> dict:
    return {"n_lines": content.count(b"\n"), "time": "2024-01-01T00:00:00Z"}


def _bad(path: str, content: bytes) -> dict:
    raise ValueError("unreadable")


_PARSERS = {"clicks": _click_lines, "views": _view_line, "bad": _bad}


@query(f"SELECT 'click' AS kind, day, count(*) AS n_lines FROM ({QUEUE}) WHERE target_table = 'click' GROUP BY 2 UNION ALL SELECT target_table, day, count(*) FROM ({QUEUE}) WHERE target_table <> 'click' GROUP BY 1, 2")
def write_bundles(spark, sf_dir):
    """Lines of the files that were written, by folder."""
    return spark.read.schema("value string, kind string, day string").text(_spool(spark, sf_dir)).groupBy("kind", "day").agg(F.count("*").alias("n_lines"))


@query(f"SELECT CASE target_table WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'bad' END AS \"table\", count(DISTINCT day) AS n_files, sum(length(CAST(id AS VARCHAR)) + 22) AS n_bytes FROM ({QUEUE}) WHERE target_table IN ('click', 'view', 'error') GROUP BY 1")
def file_spool(spark, sf_dir):
    files = spool.file_spool(spark, _spool(spark, sf_dir), _SPOOL_SPECS)
    return files.groupBy("table").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


@query(f"SELECT count(DISTINCT (target_table, day)) AS n_files, count(DISTINCT (target_table, day)) AS n_distinct FROM ({QUEUE}) WHERE target_table IN ('click', 'view', 'error')")
def spool_keep_cursor(spark, sf_dir):
    """Slices of 25 files, each from the cursor after the one before: together every file once."""
    root, after, taken = _spool(spark, sf_dir), None, None
    while True:
        files = cut(spool.file_spool(spark, root, _SPOOL_SPECS, after, 25).select("path", "mtime"))
        taken = files if taken is None else taken.unionByName(files)
        last = spool.spool_keep_cursor(files).first()
        if last.path is None:
            return taken.agg(F.count("*").alias("n_files"), F.count_distinct("path").alias("n_distinct"))
        after = (last.mtime, last.path)


def _parsed(spark, root):
    return spool.parse_spool(spool.file_spool(spark, root, _SPOOL_SPECS, content=True), _PARSERS)


@query(f"SELECT 'clicks' AS \"table\", e AS time, CAST(id AS VARCHAR) AS id, NULL AS n_lines FROM ({QUEUE}) WHERE target_table = 'click' UNION ALL SELECT 'views', 1704067200, NULL, CAST(count(*) AS VARCHAR) FROM ({QUEUE}) WHERE target_table = 'view' GROUP BY day")
def parse_spool(spark, sf_dir):
    records = _parsed(spark, _spool(spark, sf_dir))[0]
    return seconds(records.select("table", "time", F.try_element_at("columns", F.lit("id")).alias("id"), F.try_element_at("columns", F.lit("n_lines")).alias("n_lines")), "time")


@query(f"SELECT 'bad' AS \"table\", 'ValueError: unreadable' AS error, count(DISTINCT day) AS n_files FROM ({QUEUE}) WHERE target_table = 'error' HAVING count(*) > 0")
def spool_rejects(spark, sf_dir):
    return _parsed(spark, _spool(spark, sf_dir))[1].groupBy("table", "error").agg(F.count("*").alias("n_files"))


@query(f"SELECT CASE target_table WHEN 'view' THEN 'views' ELSE 'bad' END AS \"table\", count(DISTINCT day) AS n_files FROM ({QUEUE}) WHERE target_table IN ('view', 'error') GROUP BY 1")
def delete_acked(spark, sf_dir):
    """Files of acknowledged clicks are deleted; those of the others, and of files that failed, stay."""
    root = _spool(spark, sf_dir)
    acked = spool.spool_files_of(_parsed(spark, root)[0].where(F.col("table") == "clicks"))
    spool.delete_acked(acked, root)
    return spool.file_spool(spark, root, _SPOOL_SPECS).groupBy("table").agg(F.count("*").alias("n_files"))


@query(f"SELECT CASE target_table WHEN 'click' THEN 'clicks' ELSE 'views' END AS \"table\", count(DISTINCT day) AS n_files FROM ({QUEUE}) WHERE target_table IN ('click', 'view') GROUP BY 1")
def spool_files_of(spark, sf_dir):
    files = spool.spool_files_of(_parsed(spark, _spool(spark, sf_dir))[0])
    return files.groupBy(spool.chosen(spool.relative(F.col("path"), "/"), _SPOOL_SPECS).alias("table")).agg(F.count("*").alias("n_files"))


@query(f"SELECT 'ok' AS status, count(DISTINCT (target_table, day)) AS n_files, sum(length(CAST(id AS VARCHAR)) + 22) AS n_bytes FROM ({QUEUE})")
def spool_health(spark, sf_dir):
    return spool.spool_health(spark, _spool(spark, sf_dir)).drop("newest")


@query(f"SELECT 'p' || (id % 2) AS pipeline, id // 2000 AS deliverable_id, count(*) AS records, CASE WHEN id // 2000 % 2 = 0 THEN 'again' ELSE 'first' END AS try FROM ({QUEUE}) GROUP BY id % 2, id // 2000")
def payload_epochs(spark, sf_dir):
    """Two pipelines with the same ids, frozen in two epochs, one of them tried twice; what each replay then sends."""
    at = f"{scratch(spark)}/frozen"
    rows = queue(spark, sf_dir).select(F.concat(F.lit("p"), (F.col("id") % 2).cast("string")).alias("pipeline"), F.floor(F.col("id") / 2000).cast("long").alias("deliverable_id"), "id")
    of = lambda epoch, text: rows.where(F.col("deliverable_id") % 2 == epoch).withColumn("try", F.lit(text))
    for epoch, text in ((0, "first"), (1, "first"), (0, "again")):
        spool.freeze_payload(of(epoch, text), at, delivery.KEYS, epoch)
    frozen = spool.frozen_payloads(spark, at, of(0, "").schema, places=True)
    waiting = rows.select("pipeline", F.col("deliverable_id").alias("id")).distinct()
    sent = delivery.replay(waiting, frozen, lambda i, r: ("acked", r["try"].max()), now=PRESENT)
    return sent.select("pipeline", "deliverable_id", "records", F.col("reason").alias("try"))


@query(f"SELECT id // 100 AS deliverable_id, id, payload_json FROM ({QUEUE}) WHERE (id // 100) % 3 = 0")
def freeze_payload(spark, sf_dir):
    """Payloads frozen by deliverable, of which those that wait are read back."""
    rows = queue(spark, sf_dir).select(F.floor(F.col("id") / 100).cast("long").alias("deliverable_id"), "id", "payload_json").repartition("deliverable_id")
    return spool.freeze_payload(rows, f"{scratch(spark)}/frozen").where("deliverable_id % 3 = 0")


# ---- chunks --------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS batch_id FROM orders")
def chunk_by_count(spark, sf_dir):
    return chunk.chunk_by_count(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 3, ("o_orderkey",), ("o_custkey",))


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 999 AS batch_id FROM orders")
def chunk_all_by_count(spark, sf_dir):
    return chunk.chunk_by_count(table(spark, sf_dir, "orders").select("o_orderkey"), 999, ("o_orderkey",))


@query(f"SELECT id, 4 + 10 + least(octet_length(encode(call)), 255) + octet_length(encode(mode)) + octet_length(encode(grid)) + id % 5 AS size FROM ({SPOTS})")
def spot_wire_size(spark, sf_dir):
    return spots(spark, sf_dir).select("id", lines.spot_wire_size(F.col("call"), F.col("mode"), F.col("grid"), F.repeat(F.lit("x"), (F.col("id") % 5).cast("int"))).alias("size"))


@query(f"""WITH RECURSIVE s AS (SELECT *, (n - 1) // 500 AS batch_id FROM (SELECT station, id, 14 + octet_length(encode(call)) + octet_length(encode(mode)) + octet_length(encode(grid)) AS size, row_number() OVER (PARTITION BY station ORDER BY id) n FROM ({SPOTS}))),
 p AS (SELECT station, id, n, size, batch_id, size AS held, 0 AS packet FROM s WHERE (n - 1) % 500 = 0 UNION ALL SELECT s.station, s.id, s.n, s.size, s.batch_id, CASE WHEN p.held + s.size > 500 THEN s.size ELSE p.held + s.size END, CASE WHEN p.held + s.size > 500 THEN p.packet + 1 ELSE p.packet END FROM p JOIN s ON s.station = p.station AND s.batch_id = p.batch_id AND s.n = p.n + 1)
 SELECT station, id, size, batch_id, packet FROM p""")
def plan_packets(spark, sf_dir):
    rows = spots(spark, sf_dir).withColumn("size", lines.spot_wire_size(F.col("call"), F.col("mode"), F.col("grid"), F.lit("")))
    return chunk.chunk_by_bytes(rows, 600, 100, "size", ("id",), ("station",))


@query("""WITH b AS (SELECT o_custkey AS pipeline, year(o_orderdate) AS batch_id, count(*) AS n_rows FROM orders GROUP BY 1, 2), r AS (SELECT *, coalesce(sum(n_rows) OVER (PARTITION BY pipeline ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
 SELECT pipeline, batch_id, n_rows FROM r WHERE before < 6""")
def budgeted(spark, sf_dir):
    batches = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("pipeline"), F.year("o_orderdate").cast("long").alias("batch_id")).agg(F.count("*").alias("n_rows"))
    return chunk.budgeted(batches, 6)


_BATCHES = f"""SELECT id // 100 AS b, 'p' || (id // 100) % 3 AS pipeline, count(*) AS records, min(id) AS least, max(id) AS cursor_after, sum(length(payload_json)) AS n_bytes FROM ({QUEUE}) GROUP BY 1, 2"""
_SENT = f"""SELECT b AS deliverable_id, pipeline, (['acked', 'retry_later', 'permanent', 'partial_ack'])[b % 4 + 1] AS kind, CASE b % 4 WHEN 1 THEN 'ConnectionError: down' WHEN 2 THEN 'bad' ELSE '' END AS reason,
 CASE WHEN b % 4 = 3 AND b % 8 = 3 THEN least END AS accepted_cursor, records, CASE WHEN b % 4 = 3 THEN records - 1 ELSE 0 END AS rejected, CASE WHEN b % 4 <> 1 AND b % 4 <> 2 THEN n_bytes END AS n_bytes, cursor_after FROM ({_BATCHES})"""
PRESENT = datetime(2024, 1, 20, 12, 30)


def _send(batch, rows):
    """Acknowledges, is down, refuses, or takes the first row only (and then names it or not)."""
    if batch % 4 == 1:
        raise ConnectionError("down")
    if batch % 4 == 2:
        return "permanent", "bad"
    size = int(rows["payload_json"].str.len().sum())
    if batch % 4 == 3:
        return delivery.Sent("partial_ack", "", int(rows["id"].min()) if batch % 8 == 3 else None, len(rows) - 1, size)
    return delivery.Sent("acked", n_bytes=size)


def _batches(spark, sf_dir):
    batch = F.floor(F.col("id") / 100).cast("long")
    return queue(spark, sf_dir).select("id", "payload_json", batch.alias("batch_id"), F.concat(F.lit("p"), (batch % 3).cast("string")).alias("pipeline"))


def _delivered(spark, sf_dir):
    return delivery.deliver(_batches(spark, sf_dir), _send, pipeline=F.col("pipeline"), now=PRESENT)


@query(f"SELECT * FROM ({_SENT})")
def deliver(spark, sf_dir):
    return _delivered(spark, sf_dir).drop("ts")


def _folded(folded: dict[str, DataFrame]) -> DataFrame:
    """The four outputs of a fold as one table: part, pipeline, deliverable_id, and a number and a text of each."""
    row = lambda part, of, number, text: folded[part].select(F.lit(part).alias("part"), "pipeline", of.cast("long").alias("deliverable_id"), number.cast("long").alias("number"), text.cast("string").alias("text"))
    none = F.lit(None)
    out = row("cursors", F.col("seq"), F.col("cursor"), none).unionByName(row("deliverables", F.col("id"), F.unix_timestamp("next_attempt_at"), F.col("attempts")))
    return out.unionByName(row("dead_letters", F.col("deliverable_id"), none, F.col("final_error"))).unionByName(row("attempts", none, F.col("records"), F.col("outcome")))


_DELIVER_FOLD = f"""WITH o AS ({_SENT}), g AS (SELECT pipeline, min(deliverable_id) AS gap FROM o WHERE kind = 'partial_ack' AND coalesce(accepted_cursor < cursor_after, true) GROUP BY 1)
 SELECT 'cursors' AS part, pipeline, deliverable_id, CASE kind WHEN 'partial_ack' THEN accepted_cursor ELSE cursor_after END AS number, NULL AS text FROM o LEFT JOIN g USING (pipeline) WHERE (kind IN ('acked', 'permanent') OR accepted_cursor IS NOT NULL) AND (gap IS NULL OR deliverable_id <= gap)
 UNION ALL SELECT 'deliverables', pipeline, deliverable_id, {NOW_S} + 1, '0' FROM o WHERE kind = 'retry_later' UNION ALL SELECT 'dead_letters', pipeline, deliverable_id, NULL, reason FROM o WHERE kind = 'permanent'
 UNION ALL SELECT 'attempts', pipeline, NULL, CASE kind WHEN 'partial_ack' THEN records - rejected ELSE records END, kind FROM o"""


@query(_DELIVER_FOLD)
def deliver_fold(spark, sf_dir):
    """Batches sent for the first time, and their outcomes folded; cursors end at a pipeline's first batch that was taken in part."""
    return _folded(state.apply_outcomes(cut(_delivered(spark, sf_dir)), POLICY))


@query(f"""WITH o AS ({_SENT}), d AS (SELECT *, CASE WHEN deliverable_id % 5 = 2 THEN 'lost' WHEN deliverable_id % 5 = 3 THEN 'retry_later' WHEN deliverable_id % 5 = 4 THEN 'permanent' ELSE 'acked' END AS fate FROM o WHERE kind = 'retry_later')
 SELECT 'cursors' AS part, pipeline, deliverable_id, cursor_after AS number, NULL AS text FROM d WHERE fate = 'acked' UNION ALL SELECT 'deliverables', pipeline, deliverable_id, {NOW_S} + 60 + 2, '1' FROM d WHERE fate = 'retry_later'
 UNION ALL SELECT 'dead_letters', pipeline, deliverable_id, NULL, CASE fate WHEN 'lost' THEN 'no payload was frozen' ELSE 'refused' END FROM d WHERE fate IN ('lost', 'permanent') UNION ALL SELECT 'attempts', pipeline, NULL, NULL, CASE fate WHEN 'lost' THEN 'permanent' ELSE fate END FROM d""")
def replay_fold(spark, sf_dir):
    """What waits after the first attempts is frozen, and sent again from there when its time has come; a fifth lost its payload."""
    waiting = cut(state.apply_outcomes(_delivered(spark, sf_dir), POLICY)["deliverables"])
    rows = _batches(spark, sf_dir).select("pipeline", F.col("batch_id").alias("deliverable_id"), "id", "payload_json")
    frozen = spool.freeze_payload(rows.join(waiting.select("pipeline", F.col("id").alias("deliverable_id")), ["pipeline", "deliverable_id"], "left_semi").where("deliverable_id % 5 <> 2"), f"{scratch(spark)}/frozen", delivery.KEYS)

    def again(deliverable, rows):
        if deliverable % 5 == 3:
            raise ConnectionError("still down")
        return ("permanent", "refused") if deliverable % 5 == 4 else "acked"

    later = F.timestamp_seconds(F.lit(NOW_S + 60))
    outcomes_ = delivery.replay(state.due(waiting, later), frozen, again, now=datetime(2024, 1, 20, 12, 31))
    return _folded(state.apply_replays(cut(outcomes_), waiting, POLICY, once=True))


@query(f"""WITH q AS (SELECT station, e // {HOUR} * {HOUR} AS cycle, user_id % 3 AS r, epoch_ms(ts) AS ms FROM ({QUEUE})), w AS (SELECT max(ms) AS wm FROM q),
 c AS (SELECT station, cycle, count(DISTINCT r) = 3 AS complete, string_agg(DISTINCT CAST(r AS VARCHAR), ',') AS seen FROM q GROUP BY 1, 2),
 b AS (SELECT station, min(cycle) FILTER (NOT ((cycle + {HOUR}) * 1000 <= wm AND (complete OR (cycle + {HOUR} + 36000) * 1000 <= wm))) AS bad FROM c, w GROUP BY 1)
 SELECT station::VARCHAR AS station, cycle, complete, coalesce((SELECT string_agg(CAST(x.r AS VARCHAR), ',' ORDER BY x.r) FROM (VALUES (0), (1), (2)) x(r) WHERE NOT contains(seen, CAST(x.r AS VARCHAR))), '') AS missing FROM c JOIN b USING (station) WHERE bad IS NULL OR cycle < bad""")
def cycle_gate_stream(spark, sf_dir):
    """The gate over events as a stream that is drained, its rows read back from the shared folder."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select((F.col("user_id") % 10).cast("string").alias("station"), F.col("ts").alias("time"), (F.col("user_id") % 3).cast("string").alias("reporter"))
    out = scratch(spark)
    delivery.drain(gate.cycle_gate_stream(stream, ["0", "1", "2"], 36000, seconds=HOUR).writeStream.outputMode("append").format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress"))
    return seconds(spark.read.schema("station string, cycle timestamp, complete boolean, missing string").parquet(f"{out}/rows"), "cycle")


_EARLY, _FAR = "k < 60", 400 * 86400


@query(f"""WITH a AS (SELECT station, e // {HOUR} * {HOUR} AS cycle, user_id % 3 AS r, epoch_ms(ts) AS ms FROM ({QUEUE}) WHERE {_EARLY}), w AS (SELECT max(ms) AS wm FROM a),
 c AS (SELECT station, cycle, count(DISTINCT r) = 3 AS complete FROM a GROUP BY 1, 2), d AS (SELECT *, (cycle + {HOUR}) * 1000 <= wm AND (complete OR (cycle + {HOUR} + 36000) * 1000 <= wm) AS goes FROM c, w),
 b AS (SELECT station, min(cycle) FILTER (NOT goes) AS bad FROM d GROUP BY 1), p AS (SELECT station, max(cycle) AS passed FROM d JOIN b USING (station) WHERE bad IS NULL OR cycle < bad GROUP BY 1)
 SELECT id, station::VARCHAR AS station, e // {HOUR} * {HOUR} AS cycle FROM ({QUEUE}) JOIN p USING (station) WHERE NOT {_EARLY} AND e // {HOUR} * {HOUR} <= passed""")
def late_rows_stream(spark, sf_dir):
    """Events of which some arrive after the gate has let their cycles through: what comes out as late."""
    out, rows = scratch(spark), queue(spark, sf_dir).select("id", F.col("station").cast("string").alias("station"), F.col("ts").alias("time"), (F.col("user_id") % 3).cast("string").alias("reporter"), "k")
    for arrives in (_EARLY, f"NOT ({_EARLY})"):
        rows.where(arrives).write.mode("append").parquet(f"{out}/in")
        gated = gate.gate_with_late(spark.readStream.schema(rows.schema).parquet(f"{out}/in"), ["0", "1", "2"], _FAR, 36000, seconds=HOUR)
        delivery.drain(gated.writeStream.outputMode("append").format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress"))
    return seconds(spark.read.schema("part string, station string, cycle timestamp, id long").parquet(f"{out}/rows").where("part = 'late'").select("id", "station", "cycle"), "cycle")


@query(f"WITH q AS ({QUEUE}) SELECT s.id, (s.e // 120) * 120 AS cycle FROM q s WHERE target_table = 'view' AND (s.e // 120) IN (SELECT e // 120 FROM q WHERE target_table = 'click')")
def ride_along_stream(spark, sf_dir):
    """Views that fall in a cycle of clicks, both as streams that are drained."""
    out, rows = scratch(spark), queue(spark, sf_dir).select("id", "ts", "target_table")
    rows.write.partitionBy("target_table").parquet(f"{out}/in")
    read = lambda kind: spark.readStream.schema(rows.drop("target_table").schema).parquet(f"{out}/in/target_table={kind}")
    clicks = read("click").select(fields.cycle_floor(F.col("ts")).alias("cycle"))
    met = ride.ride_along_stream(clicks, read("view"), "ts", late="400 days")
    delivery.drain(met.select("id", "cycle").writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress"))
    return seconds(spark.read.schema("id long, cycle timestamp").parquet(f"{out}/rows"), "cycle")


@query(f"""SELECT 'p' || station AS pipeline, CASE station % 3 WHEN 0 THEN 'acked' WHEN 1 THEN 'acked' ELSE 'dead_letter' END AS kind, CASE station % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 2 END AS attempt, count(*) AS n_rows FROM ({QUEUE}) GROUP BY station""")
def deliver_retrying(spark, sf_dir):
    """Events as a stream to ten pipelines: some take all at once, some after two failures, some never; retries are the
    stream's own, and it is stopped and started again before they are over."""
    out, rows = scratch(spark), queue(spark, sf_dir).select("id", F.concat(F.lit("p"), F.col("station").cast("string")).alias("pipeline"), "payload_json")
    rows.write.parquet(f"{out}/in")
    total, log = rows.count(), f"{out}/log"

    def send(deliverable, batch):
        of = int(batch["pipeline"].iloc[0][1:]) % 3
        return ("retry_later", "down") if of == 2 or (of == 1 and batch.attrs["attempt"] < 2) else "acked"

    def known(kinds):
        read = spark.read.schema(retry.ATTEMPT).parquet(log) if exists(spark, f"{log}/_spark_metadata") else spark.createDataFrame([], retry.ATTEMPT)
        return read.where(F.col("kind").isin(*kinds))

    for kinds in (["acked", "retry_later"], ["acked", "dead_letter"]):
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        sent = retry.deliver_retrying(stream, send, 5_000_000, pipeline=F.col("pipeline"), policy=state.RetryPolicy(base=1.0, max_attempts=3))
        retry.run_until(retry.start_retrying(sent, log, f"{out}/progress"), lambda kinds=kinds: (known(kinds).where("kind = 'acked' OR attempt IN (0, 2)").agg(F.sum("records")).first()[0] or 0) >= total)
    return known(["acked", "dead_letter"]).groupBy("pipeline", "kind", "attempt").agg(F.sum("records").alias("n_rows"))


# ---- delivery state ------------------------------------------------------------------------------------------------

POLICY = state.RetryPolicy(max_attempts=8)
_WAIT = "least(pow(2.0, {}), 300.0)"


@query("SELECT l_suppkey AS source_id, l_linenumber AS dest_id, l_returnflag AS table_name, arg_max(l_orderkey, (l_shipdate, l_orderkey * 10 + l_linenumber)) AS cursor, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ack FROM lineitem GROUP BY 1, 2, 3")
def current_cursors(spark, sf_dir):
    log = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"), F.col("l_linenumber").alias("dest_id"), F.col("l_returnflag").alias("table_name"), F.col("l_orderkey").alias("cursor"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return state.current_cursors(log)


_RUNS = f"""WITH o AS (SELECT *, e // {HOUR} AS run FROM ({OUTCOMES})), g AS (SELECT pipeline, run, min(deliverable_id) AS gap FROM o WHERE kind = 'partial_ack' GROUP BY 1, 2),
 c AS (SELECT deliverable_id AS seq, pipeline, CASE kind WHEN 'partial_ack' THEN accepted_cursor ELSE cursor_after END AS cursor FROM o LEFT JOIN g USING (pipeline, run) WHERE kind <> 'retry_later' AND (gap IS NULL OR deliverable_id <= gap))"""


def _runs(spark, sf_dir):
    """Outcomes by hour, each hour's slice read from the cursor that the hour before left."""
    return outcomes(spark, sf_dir).withColumn("run", F.floor(F.unix_timestamp("ts") / HOUR))


@query(f"{_RUNS} SELECT * FROM c")
def outcome_cursors(spark, sf_dir):
    """What moves cursors in each slice, up to the first batch of it that was taken in part."""
    return state.apply_outcomes(_runs(spark, sf_dir), POLICY, run=("run",))["cursors"].select("seq", "pipeline", "cursor")


@query(f"{_RUNS} SELECT pipeline, max(cursor) AS cursor FROM c GROUP BY 1")
def settled_cursors(spark, sf_dir):
    return state.settled_cursors(_runs(spark, sf_dir), POLICY, run=("run",))


@query(f"SELECT deliverable_id AS seq, pipeline, CASE kind WHEN 'partial_ack' THEN accepted_cursor ELSE cursor_after END AS cursor FROM ({OUTCOMES}) WHERE kind <> 'retry_later'")
def outcome_cursors_compat(spark, sf_dir):
    """The older rule: each batch moves its cursor for itself."""
    return state.apply_outcomes(outcomes(spark, sf_dir), POLICY, compat=True)["cursors"].select("seq", "pipeline", "cursor")


@query(f"SELECT 'p' || station AS pipeline, count(*) AS n_taken, 0 AS n_waiting, 0 AS n_dead FROM ({QUEUE}) GROUP BY station")
def deliver_stream(spark, sf_dir):
    """Events as a stream to ten pipelines, of which some are down and some take parts, then two replays: rows that were
    taken, and what still waits or is dead."""
    at = scratch(spark)
    queue(spark, sf_dir).select("id", "payload_json", F.concat(F.lit("p"), F.col("station").cast("string")).alias("pipeline")).write.parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema

    def first(deliverable, rows):
        if rows["pipeline"].iloc[0] in ("p1", "p4"):
            raise ConnectionError("down")
        if rows["pipeline"].iloc[0] in ("p2", "p7") and len(rows) > 1:
            return delivery.Sent("partial_ack", accepted_cursor=int(rows["id"].iloc[len(rows) // 2]), rejected=len(rows) - len(rows) // 2 - 1)
        return "acked"

    def later(deliverable, rows):
        return ("retry_later", "busy") if rows["pipeline"].iloc[0] == "p4" else "acked"

    stream = spark.readStream.schema(schema).parquet(f"{at}/in")
    delivery.drain(delivery.deliver_stream(stream, first, f"{at}/log", f"{at}/progress", 100, pipeline=F.col("pipeline"), now=PRESENT))
    delivery.replay_stream(spark, later, f"{at}/log", schema, 0, POLICY, datetime(2024, 1, 20, 12, 31))
    delivery.replay_stream(spark, lambda i, rows: "acked", f"{at}/log", schema, 1, POLICY, datetime(2024, 1, 20, 12, 41))
    log = spark.read.parquet(f"{at}/log").select("pipeline", "kind", "records", "rejected").unionByName(spark.read.parquet(f"{at}/log/_replays").select("pipeline", "kind", "records", "rejected"))
    taken = log.where("kind IN ('acked', 'partial_ack')").groupBy("pipeline").agg(F.sum(F.col("records") - F.col("rejected")).alias("n_taken"))
    left = delivery.logged(spark, f"{at}/log", POLICY)
    return state.delivery_status(taken, taken.limit(0).withColumn("cursor", F.lit(0)), left["deliverables"], left["dead_letters"]).drop("cursor").join(taken, "pipeline")


@query(f"SELECT deliverable_id AS id, pipeline, e AS enqueued_at, 0 AS attempts, e + 1 AS next_attempt_at, cursor_after FROM ({OUTCOMES}) WHERE kind = 'retry_later'")
def outcome_deliverables(spark, sf_dir):
    return seconds(state.apply_outcomes(outcomes(spark, sf_dir), POLICY)["deliverables"], "enqueued_at", "next_attempt_at")


@query(f"SELECT deliverable_id, pipeline, coalesce(nullif(reason, ''), 'permanent_failure') AS final_error FROM ({OUTCOMES}) WHERE kind = 'permanent'")
def outcome_dead_letters(spark, sf_dir):
    return state.apply_outcomes(outcomes(spark, sf_dir), POLICY)["dead_letters"].drop("ts")


@query(f"SELECT e AS ts, pipeline, kind AS outcome, CASE kind WHEN 'partial_ack' THEN records - rejected ELSE records END AS records, n_bytes, nullif(reason, '') AS error FROM ({OUTCOMES})")
def attempts_log(spark, sf_dir):
    return seconds(state.apply_outcomes(outcomes(spark, sf_dir), POLICY)["attempts"], "ts")


_REPLAYS = f"""WITH d AS ({DELIVERABLES}), o AS (SELECT deliverable_id AS id, kind, reason, n_bytes, e AS ts FROM ({OUTCOMES}) WHERE k < 20 OR k >= 50),
 f AS (SELECT *, CASE WHEN kind IS NULL THEN 'waits' WHEN kind = 'retry_later' AND attempts + 1 >= 8 THEN 'dead_letter' WHEN kind IN ('retry_later', 'permanent') THEN kind ELSE 'acked' END AS fate FROM d LEFT JOIN o USING (id))"""


def _replays(spark, sf_dir, once: bool = False):
    return state.apply_replays(outcomes(spark, sf_dir).where("k < 20 OR k >= 50"), deliverables(spark, sf_dir), POLICY, once)


@query(f"{_REPLAYS} SELECT id AS seq, pipeline, cursor_after AS cursor FROM f WHERE fate = 'acked'")
def replay_cursors(spark, sf_dir):
    return _replays(spark, sf_dir)["cursors"].drop("ts")


@query(f"{_REPLAYS} SELECT id, pipeline, enqueued_at, CASE fate WHEN 'waits' THEN attempts ELSE attempts + 1 END AS attempts, CASE fate WHEN 'waits' THEN next_attempt_at ELSE ts + CAST({_WAIT.format('attempts + 1')} AS BIGINT) END AS next_attempt_at, cursor_after FROM f WHERE fate IN ('waits', 'retry_later')")
def replay_deliverables(spark, sf_dir):
    return seconds(_replays(spark, sf_dir)["deliverables"], "enqueued_at", "next_attempt_at")


@query(f"{_REPLAYS} SELECT pipeline, id AS deliverable_id, coalesce(nullif(reason, ''), CASE fate WHEN 'permanent' THEN 'permanent_failure' ELSE 'max_attempts' END) AS final_error FROM f WHERE fate IN ('permanent', 'dead_letter')")
def replay_dead_letters(spark, sf_dir):
    return _replays(spark, sf_dir)["dead_letters"].drop("ts")


@query(f"{_REPLAYS} SELECT ts, pipeline, fate AS outcome, CAST(NULL AS BIGINT) AS records, n_bytes, nullif(reason, '') AS error FROM f WHERE fate <> 'waits'")
def replay_attempts(spark, sf_dir):
    return seconds(_replays(spark, sf_dir)["attempts"], "ts")


@query(f"SELECT id, CASE WHEN k % 14 - 1 < 0 THEN 0.0 ELSE {_WAIT.format('k % 14 - 1')} END AS wait FROM ({QUEUE})")
def backoff(spark, sf_dir):
    return queue(spark, sf_dir).select("id", fields.backoff(F.col("k") % 14 - 1).alias("wait"))


@query(f"SELECT id, pipeline FROM ({DELIVERABLES}) WHERE next_attempt_at <= {NOW_S}")
def due(spark, sf_dir):
    return state.due(deliverables(spark, sf_dir), now()).select("id", "pipeline")


@query(f"SELECT id, pipeline FROM (SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY next_attempt_at, id) rn FROM ({DELIVERABLES}) WHERE next_attempt_at <= {NOW_S}) WHERE rn = 1")
def due_one_each(spark, sf_dir):
    return state.due(deliverables(spark, sf_dir), now(), one_each=True).select("id", "pipeline")


@query(f"SELECT id, pipeline, enqueued_at, attempts + 1 AS attempts, {NOW_S} + CAST({_WAIT.format('attempts + 1')} AS BIGINT) AS next_attempt_at, cursor_after FROM ({DELIVERABLES})")
def requeue(spark, sf_dir):
    return seconds(state.requeue(deliverables(spark, sf_dir), now()), "enqueued_at", "next_attempt_at")


@query(f"{_REPLAYS} SELECT pipeline, coalesce(nullif(reason, ''), CASE fate WHEN 'permanent' THEN 'permanent_failure' ELSE 'max_attempts' END) AS final_error, count(*) AS n_dead FROM f WHERE fate IN ('permanent', 'dead_letter') GROUP BY 1, 2")
def dead_letter_counts(spark, sf_dir):
    return state.dead_letter_counts(_replays(spark, sf_dir)["dead_letters"])


@query(f"SELECT id FROM ({QUEUE}) ORDER BY id DESC LIMIT 1000")
def trim_attempts(spark, sf_dir):
    return state.trim_attempts(queue(spark, sf_dir).select("id"), 1000, seq="id")


@query(f"SELECT id, station FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY id DESC) rn FROM ({QUEUE})) WHERE rn <= 5")
def recent_attempts(spark, sf_dir):
    return state.recent_attempts(queue(spark, sf_dir).select("id", "station"), 5, ("station",), "id")


@query(f"""{_REPLAYS} SELECT p.pipeline, c.cursor, coalesce(w.n, 0) AS n_waiting, coalesce(x.n, 0) AS n_dead, m.newest - coalesce(c.cursor, 0) AS lag FROM (SELECT target_table AS pipeline, max(id) AS newest FROM ({QUEUE}) GROUP BY 1) m JOIN (SELECT DISTINCT target_table AS pipeline FROM ({QUEUE})) p USING (pipeline)
 LEFT JOIN (SELECT pipeline, max(cursor_after) AS cursor FROM f WHERE fate = 'acked' AND pipeline <> 'view' GROUP BY 1) c USING (pipeline) LEFT JOIN (SELECT pipeline, count(*) AS n FROM f WHERE fate IN ('waits', 'retry_later') GROUP BY 1) w USING (pipeline) LEFT JOIN (SELECT pipeline, count(*) AS n FROM f WHERE fate IN ('permanent', 'dead_letter') AND pipeline <> 'click' GROUP BY 1) x USING (pipeline)""")
def delivery_status(spark, sf_dir):
    rows, folded = queue(spark, sf_dir).withColumnRenamed("target_table", "pipeline"), _replays(spark, sf_dir, once=True)
    cursors = folded["cursors"].where("pipeline <> 'view'").groupBy("pipeline").agg(F.max("cursor").alias("cursor"))
    return state.delivery_status(rows, cursors, folded["deliverables"], folded["dead_letters"].where("pipeline <> 'click'"), rows.groupBy("pipeline").agg(F.max("id").alias("newest")))


@query("SELECT l_suppkey AS source_id, max(l_orderkey) AS cursor FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1")
def reset_cursor(spark, sf_dir):
    cursors = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("source_id")).agg(F.max("l_orderkey").alias("cursor"))
    return state.reset_cursor(cursors, table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("source_id")), ("source_id",))


@query(f"SELECT id, 0 AS next_attempt_at FROM ({DELIVERABLES})")
def kick(spark, sf_dir):
    return seconds(state.kick(deliverables(spark, sf_dir)).select("id", "next_attempt_at"), "next_attempt_at")


@query(f"SELECT id, true AS accepted FROM ({QUEUE}) WHERE id <= 700 AND id % 9 <> 0 UNION ALL SELECT id, false FROM ({QUEUE}) WHERE id % 9 = 0")
def split_partial(spark, sf_dir):
    rows = queue(spark, sf_dir).select("id")
    yes, no = state.split_partial(rows, 700, rows.where("id % 9 = 0"))
    return yes.withColumn("accepted", F.lit(True)).unionByName(no.withColumn("accepted", F.lit(False)))


@query(f"SELECT station AS dest_id, target_table AS outcome, count(*) AS n_attempts, max(e) AS latest FROM ({QUEUE}) GROUP BY ROLLUP (station, target_table)")
def attempts_rollup(spark, sf_dir):
    return seconds(state.attempts_rollup(queue(spark, sf_dir).select(F.col("station").alias("dest_id"), F.col("target_table").alias("outcome"), "ts")), "latest")


@query("SELECT l_orderkey AS batch_id, arg_min('s' || l_suppkey, (l_linenumber, 's' || l_suppkey)) FILTER (l_returnflag = 'R') AS server, bool_or(l_returnflag = 'R') AS delivered, coalesce(min(l_linenumber) FILTER (l_returnflag = 'R'), count(*)) AS n_tried FROM lineitem GROUP BY 1")
def first_success(spark, sf_dir):
    tries = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("batch_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("server"), (F.col("l_linenumber") - 1).alias("pos"), (F.col("l_returnflag") == "R").alias("ok"))
    return state.first_success(tries)


# ---- tables that are rewritten, leases, tallies --------------------------------------------------------------------


@query(f"SELECT id, target_table FROM ({QUEUE}) WHERE target_table = 'view' OR (target_table = 'click' AND id > 300) OR (target_table = 'error' AND id > 10) OR target_table NOT IN ('view', 'click', 'error')")
def compact_queue(spark, sf_dir):
    """A queue of two appended parts, rewritten without what all destinations have; a reader of the old version still reads it."""
    at, rows = f"{scratch(spark)}/queue", queue(spark, sf_dir).select(*QUEUE_SCHEMA.fieldNames())
    for part in ("schema_version < 2", "schema_version >= 2"):
        versions.append(rows.where(part), at)
    old = versions.read_version(spark, at, QUEUE_SCHEMA)
    cursors = spark.sql("SELECT * FROM VALUES ('click', 'a', 300L), ('click', 'b', 900L), ('error', 'a', 10L), ('view', 'a', -1L) AS t(target_table, dest_id, cursor)")
    versions.compact_queue(spark, at, QUEUE_SCHEMA, cursors)
    now_ = versions.read_version(spark, at, QUEUE_SCHEMA)
    return now_.join(old.select("id"), "id", "left_semi").select("id", "target_table")


@query(f"SELECT id, station FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY id DESC) rn FROM ({QUEUE})) WHERE rn <= 20")
def compact_attempts(spark, sf_dir):
    at, rows = f"{scratch(spark)}/attempts", queue(spark, sf_dir).select("id", "station")
    versions.append(rows, at)
    versions.compact_attempts(spark, at, rows.schema, 20, ("station",), "id")
    versions.vacuum(spark, at, 1)
    return versions.read_version(spark, at, rows.schema)


@query("SELECT l_suppkey AS source_id, l_linenumber AS dest_id, l_returnflag AS table_name, arg_max(l_orderkey, (l_shipdate, l_orderkey * 10 + l_linenumber)) AS cursor, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ack FROM lineitem GROUP BY 1, 2, 3")
def cursors_since(spark, sf_dir):
    """The cursors of a log that grows by epochs, of which the first were folded into a snapshot."""
    at, keys = scratch(spark), ("source_id", "dest_id", "table_name")
    log = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source_id"), F.col("l_linenumber").alias("dest_id"), F.col("l_returnflag").alias("table_name"), F.col("l_orderkey").alias("cursor"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ts"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    for epoch in range(3):
        log.where(F.col("seq") % 3 == epoch).write.parquet(f"{at}/log/epoch={epoch}")
        if epoch < 2:
            versions.snapshot_cursors(spark, f"{at}/log", f"{at}/snapshots", log.schema, keys, epoch)
    return versions.cursors_since(spark, f"{at}/log", f"{at}/snapshots", log.schema, keys)


@query(f"SELECT id, target_table AS pipeline, CASE WHEN k >= 60 THEN 'b' WHEN k >= 20 AND k < 30 THEN 'd' ELSE 'c' END AS owner FROM ({QUEUE})")
def holders(spark, sf_dir):
    """Runners whose claims overlap: a leased first, b what a hadn't, c what had run out by then, and d what a gave back."""
    rows = queue(spark, sf_dir).select(F.col("target_table").alias("pipeline"), "id", "k")
    at = lambda s: F.timestamp_seconds(F.lit(NOW_S + s))
    log = claims.claim(rows.where("k < 60"), "a", at(0), 60)
    for more in (claims.claim(rows.where("k > 30"), "b", at(10), 60), claims.release(rows.where("k >= 20 AND k < 30"), "a", at(20)), claims.claim(rows.where("k >= 20 AND k < 30"), "d", at(30), 60), claims.claim(rows, "c", at(60), 60)):
        log = log.unionByName(more)
    return claims.holders(log, at(65)).select("id", "pipeline", "owner")


@query(f"SELECT mode, count(*) AS n_rows FROM ({SPOTS}) GROUP BY 1")
def live_tallies(spark, sf_dir):
    """Rows by mode as a stream observed them while it was written."""
    out, rows = scratch(spark), spots(spark, sf_dir).select("id", "mode")
    rows.write.parquet(f"{out}/in")
    seen = tally.Tallies("modes")
    spark.streams.addListener(seen)
    try:
        stream = tally.observed(spark.readStream.schema(rows.schema).parquet(f"{out}/in"), "modes", "mode", ["W2", "F2", "F5", "ft8", "FT4", "msk144", "js8"])
        delivery.drain(stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress"))
        counts = seen.wait(rows.count())
    finally:
        spark.streams.removeListener(seen)
    return spark.createDataFrame([(m, n) for m, n in counts.items() if n], "mode string, n_rows long")
