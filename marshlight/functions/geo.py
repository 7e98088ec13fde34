"""Point text, distances and candidate positions for wrong coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col

EARTH_RADIUS_KM = 6371.0088


def parse_point(geojson: Column | str) -> Column:
    """Struct(lon, lat, parse_ok) from GeoJSON point text; blank or bad text gives nulls and false.

    Only the coordinate array is read, as text, so a number written as a string is still a number.
    """
    coords = F.from_json(F.get_json_object(as_col(geojson), "$.coordinates"), "array<string>")
    ok = F.coalesce(F.size(coords) >= 2, F.lit(False))
    lon = F.when(ok, F.get(coords, F.lit(0)).try_cast("double"))
    lat = F.when(ok, F.get(coords, F.lit(1)).try_cast("double"))
    return F.struct(lon.alias("lon"), lat.alias("lat"), ok.alias("parse_ok"))


def point_text(lon: Column | str, lat: Column | str) -> Column:
    return F.format_string('{"type": "Point", "coordinates": [%f, %f]}', as_col(lon), as_col(lat))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def move_decimal(value: Column | str, lead: int) -> Column:
    """The same digits with the decimal point after the first `lead` of them; null when too short.

    The digits are those of the shortest decimal text of the number, up to 15 decimals, without an exponent.
    """
    value = as_col(value)
    text = F.abs(value).cast("decimal(38,15)").cast("string")
    text = F.regexp_replace(F.regexp_replace(text, "0+$", ""), "[.]$", "")
    digits = F.replace(text, F.lit("."), F.lit(""))
    moved = F.concat(F.substring(digits, 1, lead), F.lit("."), F.substring(digits, lead + 1, 40))
    signed = F.signum(value) * moved.try_cast("double")
    return F.when(F.length(digits) > lead, F.when(value == 0, F.lit(0.0)).otherwise(signed))


def position_candidates(lon: Column | str, lat: Column | str, max_shift: int = 2) -> Column:
    """Ordered array of struct(method, lon, lat) to try for a point that lies outside the country."""
    lon, lat = as_col(lon), as_col(lat)
    # Method names in order of preference.
    pairs = [
        ("ORIGINAL", lon, lat),
        ("SWAP", lat, lon),
        ("FLIP_LAT", lon, -lat),
        ("FLIP_LON", -lon, lat),
        ("FLIP_BOTH", -lon, -lat),
        ("SWAP_FLIP_LAT", lat, -lon),
        ("SWAP_FLIP_LON", -lat, lon),
        ("SWAP_FLIP_BOTH", -lat, -lon),
    ]
    for k in range(1, max_shift + 1):
        lon_k, lat_k = move_decimal(lon, k), move_decimal(lat, k)
        pairs += [
            (f"DECIMAL_LR_LON_{k}", lon_k, lat),
            (f"DECIMAL_LR_LAT_{k}", lon, lat_k),
            (f"DECIMAL_LR_BOTH_{k}", lon_k, lat_k),
            (f"SWAP_DECIMAL_LR_LON_{k}", lat_k, lon),
            (f"SWAP_DECIMAL_LR_LAT_{k}", lat, lon_k),
            (f"SWAP_DECIMAL_LR_BOTH_{k}", lat_k, lon_k),
        ]
    return F.array(
        *[F.struct(F.lit(m).alias("method"), x.alias("lon"), y.alias("lat")) for m, x, y in pairs]
    )


def on_earth(lon: Column | str, lat: Column | str) -> Column:
    return (F.abs(as_col(lon)) <= 180) & (F.abs(as_col(lat)) <= 90)
