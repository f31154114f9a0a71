"""Report lines. Each table of formats is rendered in Arrow batches, so that digits round as printf rounds them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: The layouts of report lines.
EXTENDED = "%6s %4s %5.2f %6.2f %5.2f %12.7f %-14s %-6s %2d %2d %4d %4d %4d %4d %2d %3d %3d %2d %6.1f %6.1f %4d %6s %12s %5d %6.1f %6.1f %6.1f %6.1f %6.1f %6.1f %6.1f %6.1f %4d %4d"
SHORT_W = "%-6s %4s %5.2f %3d %5.2f %12.7f %-14s %-6s %2d %2d %4d"
SHORT_F = "%-6s %4s %5.1f %3.0f %5.2f %12.7f %-14s %-6s %2d  0 %4d"
NOISE = "%5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %5.2f %d"


def render(layout: str, *values: Column) -> Column:
    """printf of the values; null where one of them is null."""

    @pandas_udf("string")
    def line(*columns: pd.Series) -> pd.Series:
        return pd.Series([None if any(v is None or v != v for v in row) else layout % row for row in zip(*columns, strict=True)], dtype="object")

    return line(*values)


def minute_drift(hz_per_s: Column) -> Column:
    """Hz a minute, to the nearest even at halves."""
    return F.bround(F.coalesce(hz_per_s, F.lit(0.0)) * 60).cast("long")


def noise_line(rms: Column, fft: Column, overloads: Column) -> Column:
    """Fifteen fields, of which twelve aren't measured and are 0."""
    number = lambda c, kind: F.coalesce(c.cast(kind), F.lit(0).cast(kind))
    return render(NOISE, *[F.lit(0.0)] * 12, number(rms, "double"), number(fft, "double"), number(overloads, "long"))


def short_line(ts: Column, sync: Column, snr: Column, dt: Column, mhz: Column, call: Column, grid: Column, power: Column, drift: Column, kind: Column, w_mode: Column) -> Column:
    """The eleven-field line, in the layout of W or of F modes; null where it can't be rendered. Each row is rendered once."""

    @pandas_udf("string")
    def line(w_mode: pd.Series, *columns: pd.Series) -> pd.Series:
        out = []
        for w, (*head, snr, dt, mhz, call, grid, power, drift, kind) in zip(w_mode, zip(*columns, strict=True), strict=True):
            row = (*head, int(snr) if w and snr == snr else snr, dt, mhz, call, grid, power, *([drift] if w else []), kind)
            out.append(None if any(v is None or v != v for v in row) else (SHORT_W if w else SHORT_F) % row)
        return pd.Series(out, dtype="object")

    return line(F.coalesce(w_mode, F.lit(False)), F.date_format(ts, "yyMMdd"), F.date_format(ts, "HHmm"), sync, snr.cast("double"), dt, mhz, call, grid, power, drift, kind)


def spot_wire_size(call: Column, mode: Column, locator: Column, message: Column) -> Column:
    """Bytes of an encoded spot: four length-prefixed strings of up to 255 bytes, frequency, SNR, source and time."""
    text = lambda c: 1 + F.least(F.coalesce(F.octet_length(c), F.lit(0)), F.lit(255))
    return (text(call) + 4 + 1 + text(mode) + text(locator) + 1 + 4 + text(message)).cast("int")
