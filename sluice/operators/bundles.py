"""Rows shaped into lines, files and rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import lines
from sluice.functions.fields import cycle_floor, filled, rx_site
from sluice.functions.geo import ABSENT, NO_BAND, angle, band_of, grid_lat, grid_lon, path_geometry
from sluice.operators.dedup import best_spot, noise_last_wins
from sluice.operators.predicates import reportable, supported_modes


def label_receivers(df: DataFrame, call: Sequence[str] = ("rx_call",), grid: Sequence[str] = ("rx_grid",), receiver: Sequence[str] = ("radiod_id", "rx_source"), default: dict[str, str] | None = None) -> DataFrame:
    """site_call, site_grid, receiver and rx_site of each row, with defaults for rows that don't say."""
    default = {"call": "", "grid": "", "receiver": "rx"} | (default or {})
    have = set(df.columns)
    first = lambda names, other: F.coalesce(filled(*[F.col(n) for n in names if n in have], F.lit(other)), F.lit(""))
    raw = F.replace(F.replace(first(receiver, default["receiver"]), F.lit("radiod:"), F.lit("")), F.lit("-status.local"), F.lit(""))
    out = df.withColumns({"site_call": first(call, default["call"]), "site_grid": first(grid, default["grid"]), "receiver": filled(raw, F.lit(default["receiver"]))})
    return out.withColumn("rx_site", rx_site(F.col("site_call"), F.col("site_grid")))


def enrich_paths(spots: DataFrame, receivers: DataFrame, on: Sequence[str] = ("receiver",), grid: str = "grid", rx_grid: str = "rx_grid", mhz: str = "mhz", compat: bool = False) -> DataFrame:
    """Spots with band, distance, azimuths and vertex; null where a grid isn't known. Receivers are a dimension."""
    joined = spots.join(receivers.select(*on, F.col(rx_grid).alias("_rx_grid")), list(on), "left")
    both = F.col("_tx").isNotNull() & F.col("_rx").isNotNull()
    points = joined.withColumns({"_tx": grid_lat(F.col(grid)), "_rx": grid_lat(F.col("_rx_grid"))})
    ends = {"tx_lat": F.col("_tx"), "tx_lon": grid_lon(F.col(grid)), "rx_lat": F.col("_rx"), "rx_lon": grid_lon(F.col("_rx_grid"))}
    points = points.withColumns({name: F.when(both, c) for name, c in ends.items()}).withColumn("_angle", angle(*map(F.col, ends)))
    columns = {"band": band_of(F.col(mhz), compat), **path_geometry(*map(F.col, [*ends, "_angle"]))}
    return points.withColumns(columns).drop("_rx_grid", "_tx", "_rx", "_angle")


def render_lines(spots: DataFrame, time: str = "time", into: str = "line") -> DataFrame:
    """Normalised spots that can be reported, each with its line; W modes, or kind 2 without a mode, by their layout."""
    ready = reportable(spots)
    w_mode = F.when(F.coalesce("mode", F.lit("")) != "", F.col("mode").startswith("W")).otherwise(F.col("kind") == 2)
    line = lines.short_line(F.col(time), F.col("sync"), F.col("snr"), F.col("dt"), F.col("mhz"), F.trim("call"), F.col("grid"), F.col("power"), F.col("drift"), F.col("kind"), w_mode)
    return ready.withColumn(into, line).where(F.col(into).isNotNull())


def extended_lines(spots: DataFrame, time: str = "time", into: str = "line") -> DataFrame:
    """Spots with path columns and site_call, site_grid, as 34-field lines; what isn't known of a path is -999."""
    c = lambda name, kind="long": F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))
    path = lambda name: F.coalesce(F.col(name), F.lit(ABSENT))
    zero = F.lit(0).cast("long")
    values = [
        F.date_format(time, "yyMMdd"), F.date_format(time, "HHmm"), c("sync", "double"), c("snr", "double"), c("dt", "double"), F.col("mhz"), F.col("call"), F.coalesce(F.nullif(F.col("grid"), F.lit("")), F.lit("none")),
        c("power"), c("drift"), c("cycles"), c("jitter"), c("blocksize"), F.bround(c("metric", "double") * 1000).cast("long"), c("decodetype"), c("ipass"), c("nhardmin"), F.coalesce(F.nullif(F.col("kind"), F.lit(0)), F.lit(2)).cast("long"),
        F.lit(0.0), F.lit(0.0), F.coalesce("band", F.lit(NO_BAND)).cast("long"), F.coalesce("site_grid", F.lit("")), F.coalesce("site_call", F.lit("")), F.bround(path("km")).cast("long"),
        *[path(n) for n in ("rx_az", "rx_lat", "rx_lon", "tx_az", "tx_lat", "tx_lon", "v_lat", "v_lon")], zero, zero,
    ]
    return spots.withColumn(into, lines.render(lines.EXTENDED, *values)).where(F.col(into).isNotNull())


def joined_lines(order: Sequence[str], line: str = "line") -> Column:
    """The lines of a group in order, each ended; order has the columns that decide."""
    return F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line))), lambda x: x[line]), "\n"), F.lit("\n"))


def bundle_spots(df: DataFrame, time: str = "time", order: Sequence[str] = ("id",), line: str = "line", keys: tuple[str, ...] = ()) -> DataFrame:
    """A file for each receiver, band, mode and time: keys, arcname, n_lines, content in order of id."""
    w = F.col("mode").startswith("W")
    name = F.concat(F.concat_ws("_", "receiver", F.col("band").cast("string"), "mode", F.date_format("file_time", "yyyyMMdd_HHmmss")), F.when(w, "_wd_spots.txt").otherwise("_spots.txt"))
    grouped = df.withColumn("file_time", F.col(time)).groupBy(*keys, "rx_site", "receiver", "band", "mode", "file_time").agg(F.count("*").alias("n_lines"), joined_lines(order, line).alias("content"))
    return grouped.select(*keys, F.concat_ws("/", F.lit("spots"), "rx_site", "receiver", F.col("band").cast("string"), name).alias("arcname"), "n_lines", "content")


def bundle_digital(df: DataFrame, fields: Sequence[str], time: str = "time", hz: str = "frequency", keys: tuple[str, ...] = (), order: Sequence[str] = ()) -> DataFrame:
    """A JSON-lines file for each mode, site, receiver, band and cycle, its fields by name, its rows by time and frequency.

    Rows of one time and frequency are in order of the columns ``order``, by their own types, and then of their text.
    """
    ready = supported_modes(df).withColumns({"mode": F.lower("mode"), "line": F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"}), "cycle": cycle_floor(F.col(time))})
    grouped = ready.groupBy(*keys, "mode", "rx_site", "receiver", "band", "cycle").agg(F.count("*").alias("n_lines"), joined_lines((time, hz, *order)).alias("content"))
    name = F.concat(F.date_format("cycle", "yyMMdd_HHmm"), F.lit("_"), "mode", F.lit(".jsonl"))
    return grouped.select(*keys, F.concat_ws("/", "mode", "rx_site", "receiver", F.col("band").cast("string"), name).alias("arcname"), "n_lines", "content")


def bundle_noise(df: DataFrame, time: str = "time", id_col: str = "id") -> DataFrame:
    """A one-line file for each receiver, band and time, from the last row written."""
    last = noise_last_wins(df, ("rx_site", "receiver", "band", time), id_col)
    name = F.concat_ws("_", "receiver", F.col("band").cast("string"), F.date_format(time, "yyyyMMdd_HHmmss"), F.lit("noise.txt"))
    line = lines.noise_line(F.col("rms_noise_dbm"), F.col("fft_noise_dbm"), F.col("overload_count"))
    return last.select(F.concat_ws("/", F.lit("noise"), "rx_site", "receiver", F.col("band").cast("string"), name).alias("arcname"), F.concat(line, F.lit("\n")).alias("content"))


def routing_flags(df: DataFrame, keys: tuple[str, ...] = (), receiver: Sequence[str] = ("rx_site", "receiver"), flag: str = "forward") -> DataFrame:
    """keys, default_flag and overrides (JSON, by receiver) of what may be passed on.

    A receiver's flag is false if any of its rows says so; the default is the majority's, true in a tie.
    """
    each = df.groupBy(*keys, F.concat_ws("/", *receiver).alias("_receiver")).agg(F.bool_and(F.coalesce(flag, F.lit(True))).alias("_flag"))
    default = F.count_if("_flag") * 2 >= F.count("*")
    of = each.groupBy(*keys).agg(default.alias("default_flag"), F.array_sort(F.collect_list(F.struct("_receiver", "_flag"))).alias("_all"))
    minority = F.filter("_all", lambda x: x["_flag"] != F.col("default_flag"))
    return of.select(*keys, "default_flag", F.to_json(F.map_from_entries(minority)).alias("overrides"))


def report_body(spots: DataFrame, batch: tuple[str, ...], time: str = "time") -> DataFrame:
    """A body of lines for each batch: the best spots, rendered, by minute and frequency.

    A body is one value, so batches have to be bounded: number them by chunk_by_count and name batch_id among ``batch``.
    """
    if not batch:
        raise ValueError("a body of all rows has no bound: cut them by chunk_by_count first")
    line = render_lines(best_spot(spots, batch, time), time).withColumns({"_minute": F.date_trunc("minute", time)})
    grouped = line.groupBy(*batch).agg(F.count("*").alias("n_lines"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_minute", "mhz", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return grouped


def cycle_counts(spots: DataFrame, time: str = "time", keys: tuple[str, ...] = ()) -> DataFrame:
    """Spots by HH:MM after the best of each were taken."""
    return best_spot(spots, keys, time).groupBy(*keys, F.date_format(time, "HH:mm").alias("hhmm")).agg(F.count("*").alias("n_spots"))


def mode_counts(df: DataFrame, by: Sequence[str] = ("pipeline", "mode", "outcome")) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def acceptance_rate(outcomes: DataFrame, text: str = "response", by: Sequence[str] = ("dest_id", "day")) -> DataFrame:
    """Added and sent reports by what servers said: "N out of M spot..."; text that says nothing counts as nothing."""
    number = lambda i: F.regexp_extract(text, r"(\d+)\s+out of\s+(\d+)\s+spot", i).try_cast("long")
    sums = outcomes.groupBy(*by).agg(F.sum(number(1)).alias("n_added"), F.sum(number(2)).alias("n_sent"))
    return sums.withColumn("rate", F.try_divide("n_added", "n_sent"))


RESULT = "nonce string, status string, accepted long, submitted long, rejected long, processing_ms long, rejections array<struct<reason:string,count:long>>"


def submission_results(df: DataFrame, text: str = "response", by: Sequence[str] = ("dest_id",)) -> tuple[DataFrame, DataFrame]:
    """Sums of status messages by destination and status, and their rejections by reason; unreadable ones are failed."""
    read = df.select(*by, F.from_json(text, RESULT).alias("r")).select(*by, "r.*").withColumn("status", F.coalesce("status", F.lit("failed")))
    sums = read.groupBy(*by, "status").agg(F.count("*").alias("n_messages"), F.sum("accepted").alias("n_accepted"), F.sum("submitted").alias("n_submitted"))
    reasons = read.select(*by, F.explode("rejections").alias("x")).groupBy(*by, F.col("x.reason").alias("reason")).agg(F.sum(F.coalesce("x.count", F.lit(1))).alias("n_rejected"))
    return sums, reasons
