"""Column expressions on JSON payloads, times and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(payload: Column) -> Column:
    """The payload as a variant; null where it is no JSON."""
    return F.try_parse_json(payload)


def json_field(variant: Column, name: str, kind: str = "string") -> Column:
    """A field of a variant as ``kind``; null where it is absent or of another kind (text against a number)."""
    return F.try_variant_get(variant, f"$.{name}", kind)


def lenient_double(text: Column) -> Column:
    """A number, or 0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def lenient_int(text: Column) -> Column:
    """A whole number, towards zero, or 0."""
    return F.coalesce(text.try_cast("double").cast("long"), F.lit(0)).cast("long")


def record_time(variant: Column, queued_at: Column, now: Column | None = None, fields: tuple[str, ...] = ("time", "decode_time", "utc")) -> Column:
    """The first field that reads as a time, else when the row was queued, else ``now``; naive times are UTC."""
    times = [json_field(variant, f).try_cast("timestamp") for f in fields]
    return F.coalesce(*times, queued_at.try_cast("timestamp"), *([now] if now is not None else []))


def cycle_floor(ts: Column, seconds: int = 120, buffer: int = 0) -> Column:
    """Start of the cycle that ts, less a safety buffer, lies in."""
    return F.timestamp_seconds(F.floor((F.unix_timestamp(ts) - buffer) / seconds) * seconds)


def past_backstop(cycle: Column, now: Column, backstop: int, seconds: int = 120) -> Column:
    """Whether a cycle is over by more than ``backstop`` seconds."""
    return F.unix_timestamp(cycle) < F.unix_timestamp(now) - (seconds + backstop)


def time_parts(ts: Column) -> dict[str, Column]:
    """The text forms of a time that lines and file names use."""
    return {"date": F.date_format(ts, "yyMMdd"), "hhmm": F.date_format(ts, "HHmm"), "file_ts": F.date_format(ts, "yyyyMMdd_HHmmss"), "cycle_ts": F.date_format(ts, "yyMMdd_HHmm")}


def clamp_snr(snr: Column) -> Column:
    """Within a signed byte; null is the least."""
    return F.greatest(F.lit(-128), F.least(F.lit(127), F.coalesce(snr.cast("int"), F.lit(-128))))


def rx_site(call: Column, grid: Column) -> Column:
    """Call with = for /, and the grid after an underscore if there is one."""
    return F.concat_ws("_", F.replace(call, F.lit("/"), F.lit("=")), F.nullif(grid, F.lit("")))


def filled(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns])


def backoff(attempt: Column, base: float = 2.0, cap: float = 300.0) -> Column:
    """Seconds until the next try; a negative attempt waits 0."""
    return F.when(attempt < 0, F.lit(0.0)).otherwise(F.least(F.pow(F.lit(base), attempt), F.lit(cap)))
