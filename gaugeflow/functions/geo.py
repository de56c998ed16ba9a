"""Coordinates to WGS84 longitude/latitude with closed-form column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid (WGS84 differs below the output precision), UTM scale and offsets.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0


def epsg_number(name: Column) -> Column:
    """The number in ``25832``, ``EPSG:25832``, ``urn:ogc:def:crs:EPSG::25832`` or a CRS link."""
    return F.regexp_extract(name, r"([0-9]+)$", 1).try_cast("int")


def _utm_zone(epsg: Column) -> Column:
    """UTM zone number, negative on the southern half, NULL for other systems."""
    return (
        F.when(epsg.between(25828, 25838), epsg - 25800)
        .when(epsg.between(32601, 32660), epsg - 32600)
        .when(epsg.between(32701, 32760), 32700 - epsg)
    )


def _inverse_utm(easting: Column, northing: Column, zone: Column) -> tuple[Column, Column]:
    """Inverse transverse Mercator, Krüger series to the third order of n."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    south = F.when(zone < 0, FALSE_NORTHING_SOUTH).otherwise(0.0)
    xi = (northing - south) / F.lit(radius * UTM_SCALE)
    eta = (easting - F.lit(FALSE_EASTING)) / F.lit(radius * UTM_SCALE)
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(delta, start=1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    meridian = F.abs(zone) * 6 - 183
    return F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p))) + meridian, F.degrees(phi)


def to_wgs84(first: Column, second: Column, crs: Column | str | None, scale: int = 6, flip: bool = False) -> Column:
    """``struct(lon, lat, error)`` rounded half-even.

    EPSG:4326 and input without CRS are (latitude, longitude); UTM is (easting, northing).
    Other systems give an error text and no coordinates.
    """
    a, b = (second, first) if flip else (first, second)
    a, b = a.cast("double"), b.cast("double")
    name = F.lit(crs).cast("string") if crs is None or isinstance(crs, str) else crs
    epsg = epsg_number(name)
    plain = F.coalesce(name, F.lit("")) == ""
    geographic = plain | (epsg == 4326)
    zone = _utm_zone(epsg)
    utm_lon, utm_lat = _inverse_utm(a, b, zone)
    lon = F.when(geographic, b).when(zone.isNotNull(), utm_lon)
    lat = F.when(geographic, a).when(zone.isNotNull(), utm_lat)
    known = F.coalesce(geographic | zone.isNotNull(), F.lit(False))
    return F.struct(
        F.bround(lon, scale).alias("lon"),
        F.bround(lat, scale).alias("lat"),
        F.when(~known, F.concat(F.lit("Unsupported coordinate system "), name)).alias("error"),
    )


def position_to_wgs84(position: Column, crs: Column | str | None, scale: int = 6, flip: bool = False) -> Column:
    """Same for a ``"a b"`` text position."""
    parts = F.split(position, " ")
    return to_wgs84(
        F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"), crs, scale, flip
    )
