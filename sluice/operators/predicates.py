"""Gates and projections of queue rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from operator import eq, ge, gt, le, lt, ne

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fields import filled, json_field, parsed, record_time

_COMPARE = {"=": eq, "!=": ne, "<": lt, ">": gt, "<=": le, ">=": ge}
_NAME = re.compile(r"^[A-Za-z_]\w*$")


def schema_gate(df: DataFrame, accepted: Sequence[int], version: str = "schema_version") -> DataFrame:
    """Rows of accepted versions; an empty list is no gate."""
    return df.where(F.col(version).isin(*accepted)) if accepted else df


def stale_schema(df: DataFrame, accepted: Sequence[int], keys: tuple[str, ...] = (), version: str = "schema_version") -> DataFrame:
    """Rows by key and version that no one accepts; reported whether or not there are good rows."""
    stale = df.where(~F.col(version).isin(*accepted)) if accepted else df.limit(0)
    return stale.groupBy(*keys, version).agg(F.count("*").alias("n_rows"))


def _kind(value) -> str:
    return "boolean" if isinstance(value, bool) else "long" if isinstance(value, int) else "double" if isinstance(value, float) else "string"


def payload_where(df: DataFrame, conditions: Sequence[tuple[str, str, object]], payload: str = "payload") -> DataFrame:
    """Rows whose payload (a variant) meets every (field, operator, value); a missing field meets none, != included."""
    for name, op, value in conditions:
        if not _NAME.match(name):
            raise ValueError(f"no field name: {name!r}")
        values = list(value) if op in ("IN", "NOT IN") else [value]
        if op not in (*_COMPARE, "IN", "NOT IN") or not values:
            raise ValueError(f"no condition: {op!r} {value!r}")
        field = json_field(F.col(payload), name, _kind(values[0]))
        if op in _COMPARE:
            df = df.where(_COMPARE[op](field, F.lit(value)))
        else:
            df = df.where(field.isin(*values) if op == "IN" else ~field.isin(*values))
    return df


def ceiling(df: DataFrame, column: str | Column, value: object | DataFrame | None) -> DataFrame:
    """Rows up to a value; None is no rows. A one-row table gives the value without a trip to the driver."""
    at = F.col(column) if isinstance(column, str) else column
    if value is None:
        return df.limit(0)
    if isinstance(value, DataFrame):
        name = value.columns[0]
        one = value.agg(F.max(name).alias("_ceiling"))
        return df.withColumn("_at", at).join(F.broadcast(one), F.col("_at") <= F.col("_ceiling")).drop("_at", "_ceiling")
    return df.where(at <= F.lit(value))


def read_payload(df: DataFrame, payload: str = "payload_json") -> DataFrame:
    """Rows with the payload as a variant, which is null where the payload is no JSON (or null): one scan for both kinds."""
    return df.withColumn("payload", parsed(F.col(payload)))


def quarantine(df: DataFrame, payload: str = "payload_json") -> tuple[DataFrame, DataFrame]:
    """Rows with the payload as a variant, and the rows whose payload is no JSON (null ones too).

    Where both are wanted at once, read_payload() has them in one scan.
    """
    read = read_payload(df, payload)
    return read.where("payload is not null"), read.where("payload is null").drop("payload")


def project_payload(df: DataFrame, fields: dict[str, str], keep: Sequence[str] = (), payload: str = "payload") -> DataFrame:
    """Named fields of the payload by kind, null where missing, beside the columns to keep."""
    return df.select(*keep, *[json_field(F.col(payload), name, kind).alias(name) for name, kind in fields.items()])


def with_record_time(df: DataFrame, now: Column | None = None, payload: str = "payload", queued: str = "queued_at", into: str = "time") -> DataFrame:
    """The record's own time, else the queue's; ``now`` fills what has neither."""
    return df.withColumn(into, record_time(F.col(payload), F.col(queued), now))


def with_accepted(df: DataFrame, accepted: DataFrame, targets: tuple[str, ...] = ("target_table",), version: str = "schema_version", into: str = "accepted") -> DataFrame:
    """Every row and whether the table of (targets, version) lists it; nulls are not listed. One scan and one join."""
    on = [*targets, version]
    return df.join(accepted.select(*on).distinct().withColumn(into, F.lit(True)), on, "left").withColumn(into, F.coalesce(into, F.lit(False)))


def accepts(df: DataFrame, accepted: DataFrame, targets: tuple[str, ...] = ("target_table",), version: str = "schema_version") -> tuple[DataFrame, DataFrame]:
    """Rows that the table of (targets, version) lists, and the rows that it doesn't (nulls among them)."""
    marked = with_accepted(df, accepted, targets, version, "_accepted")
    return marked.where("_accepted").drop("_accepted"), marked.where("not _accepted").drop("_accepted")


def reportable(df: DataFrame, call: str = "call", mhz: str = "mhz") -> DataFrame:
    """Rows with a call that is resolved and a frequency; <CALL> stays, <...> goes."""
    return df.where((F.trim(call) != "") & (F.trim(call) != "<...>") & F.col(mhz).isNotNull() & (F.col(mhz) != 0))


def supported_modes(df: DataFrame, modes: Sequence[str] = ("ft8", "ft4", "msk144"), mode: str = "mode") -> DataFrame:
    return df.where(F.lower(mode).isin(*modes))


def normalize_spot(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """One set of names for both generations of spot records: call, mhz, sync, snr, dt, power, drift, kind, grid, mode.

    A first name that is empty or 0 gives way for call, frequency and grid; for numbers only a null does.
    """
    v = F.col(payload)
    text, number = (lambda n: json_field(v, n)), (lambda n: json_field(v, n, "double"))
    hz = F.coalesce(F.nullif(number("frequency"), F.lit(0.0)), F.nullif(number("frequency_hz"), F.lit(0.0)))
    drift = F.coalesce(number("drift").cast("long"), F.bround(number("drift_hz_per_s") * 60).cast("long"), F.lit(0).cast("long"))
    return df.select(
        *keep,
        filled(text("tx_sign"), text("tx_call"), text("callsign")).alias("call"),
        F.coalesce(number("frequency_mhz"), hz / 1e6).alias("mhz"),
        F.coalesce(number("sync_quality"), F.lit(0.0)).alias("sync"),
        F.coalesce(number("snr"), number("snr_db"), F.lit(0.0)).alias("snr"),
        F.coalesce(number("dt"), F.lit(0.0)).alias("dt"),
        F.coalesce(number("power"), number("pwr_dbm"), F.lit(0.0)).cast("long").alias("power"),
        drift.alias("drift"),
        F.coalesce(number("code"), number("pkt_mode"), F.lit(0.0)).cast("long").alias("kind"),
        F.coalesce(filled(text("tx_loc"), text("grid")), F.lit("")).alias("grid"),
        F.upper(F.trim(text("mode"))).alias("mode"),
    )


def normalize_digital(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """call, hz, snr (else the decoder's score, else -128), mode (upper case, FT8 if none), locator, message bytes."""
    v = F.col(payload)
    number = lambda n: json_field(v, n, "double")
    text = lambda n: json_field(v, n)
    return df.select(
        *keep,
        filled(text("tx_call"), text("callsign")).alias("call"),
        F.coalesce(F.nullif(number("frequency"), F.lit(0.0)), F.nullif(number("frequency_hz"), F.lit(0.0))).cast("long").alias("hz"),
        F.coalesce(number("snr_db"), number("score"), F.lit(-128.0)).cast("int").alias("snr"),
        F.upper(F.coalesce(F.nullif(text("mode"), F.lit("")), F.lit("FT8"))).alias("mode"),
        F.coalesce(filled(text("grid"), text("locator")), F.lit("")).alias("locator"),
        F.coalesce(F.unhex(text("message_bytes")), F.lit(b"")).alias("message"),
    )
