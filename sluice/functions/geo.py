"""Bands, grid locators and great-circle paths as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tenths of MHz to metre band, by exact key.
BAND_KEYS = {1: 2200, 4: 630, 18: 160, 35: 80, 52: 60, 53: 60, 70: 40, 101: 30, 140: 20, 181: 17, 210: 15, 249: 12, 281: 10, 502: 6, 700: 4, 1444: 2, 4323: 70, 12965: 23}
#: Amateur bands in MHz, from and to, with their metre bands.
BAND_RANGES = ((0.1357, 0.1378, 2200), (0.472, 0.479, 630), (1.8, 2.0, 160), (3.5, 4.0, 80), (5.06, 5.45, 60), (7.0, 7.3, 40), (10.1, 10.15, 30), (14.0, 14.35, 20), (18.068, 18.168, 17), (21.0, 21.45, 15), (24.89, 24.99, 12), (28.0, 29.7, 10), (50.0, 54.0, 6), (70.0, 70.5, 4), (144.0, 148.0, 2), (420.0, 450.0, 70), (1240.0, 1300.0, 23))
NO_BAND = 9999
#: What rendered lines have for a path that isn't known.
ABSENT = -999.0
EARTH_KM = 6371.0


def band_of(mhz: Column, compat: bool = False) -> Column:
    """The metre band of a frequency, NO_BAND outside all; ``compat`` uses the exact keys, which miss parts of bands."""
    if compat:
        table = F.create_map(*[F.lit(x) for x in chain(*BAND_KEYS.items())])
        return F.coalesce(F.try_element_at(table, F.floor(mhz * 10).cast("int")), F.lit(NO_BAND))
    out = F.lit(NO_BAND)
    for low, high, band in BAND_RANGES:
        out = F.when(mhz.between(low, high), band).otherwise(out)
    return out


def _valid(grid: Column) -> Column:
    return F.upper(F.trim(grid)).rlike("^[A-R]{2}[0-9]{2}")


def _six(g: Column) -> Column:
    return g.rlike("^.{4}[A-X]{2}$")


def grid_lat(grid: Column) -> Column:
    """Latitude of a locator's centre: of the sub-square of 6 characters, of the square for other lengths; else null."""
    g = F.upper(F.trim(grid))
    base = (F.ascii(F.substring(g, 2, 1)) - 65) * 10.0 + (F.ascii(F.substring(g, 4, 1)) - 48) - 90.0
    return F.when(_valid(grid), base + F.when(_six(g), (F.ascii(F.substring(g, 6, 1)) - 65 + 0.5) / 24.0).otherwise(0.5))


def grid_lon(grid: Column) -> Column:
    """Longitude of a locator's centre: of the sub-square of 6 characters, of the square for other lengths; else null."""
    g = F.upper(F.trim(grid))
    base = (F.ascii(F.substring(g, 1, 1)) - 65) * 20.0 + (F.ascii(F.substring(g, 3, 1)) - 48) * 2.0 - 180.0
    return F.when(_valid(grid), base + F.when(_six(g), (F.ascii(F.substring(g, 5, 1)) - 65 + 0.5) / 12.0).otherwise(1.0))


def path_geometry(tx_lat: Column, tx_lon: Column, rx_lat: Column, rx_lon: Column, angle: Column) -> dict[str, Column]:
    """km, azimuths at both ends and the path's northern- or southernmost point, from coordinates and their angle()."""
    p, q, d = F.radians(tx_lat), F.radians(rx_lat), F.radians(tx_lon - rx_lon)
    rx_az = F.pmod(F.degrees(F.atan2(F.sin(d) * F.cos(p), F.cos(q) * F.sin(p) - F.sin(q) * F.cos(p) * F.cos(d))), F.lit(360.0))
    tx_az = F.pmod(F.degrees(F.atan2(F.sin(-d) * F.cos(q), F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(d))), F.lit(360.0))
    top = F.when(angle > 1e-9, F.acos(F.least(F.lit(1.0), F.cos(q) * F.cos(p) * F.abs(F.sin(d / 2)) / F.sin(angle / 2)))).otherwise(q)
    v_lat = F.when(angle.isNotNull(), F.degrees(top) * F.when(tx_lat > rx_lat, 1).otherwise(-1))
    return {"km": EARTH_KM * angle, "rx_az": rx_az, "tx_az": tx_az, "v_lat": v_lat, "v_lon": (tx_lon + rx_lon) / 2}


def angle(tx_lat: Column, tx_lon: Column, rx_lat: Column, rx_lon: Column) -> Column:
    """The great-circle angle between two points in radians; null where a coordinate is."""
    p, q, d = F.radians(tx_lat), F.radians(rx_lat), F.radians(tx_lon - rx_lon)
    half = F.pow(F.sin((p - q) / 2), 2) + F.cos(q) * F.cos(p) * F.pow(F.sin(d / 2), 2)
    return F.when(half.isNotNull(), 2 * F.atan2(F.sqrt(half), F.sqrt(F.greatest(F.lit(0.0), 1 - half))))
