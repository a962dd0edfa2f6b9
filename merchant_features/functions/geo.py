"""Points on the sphere: distance and the sanitising of unreliable coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchant_features.functions.columns import ColumnLike, as_column

EARTH_RADIUS_KM = 6371.01

# The province whose city districts carry no usable coordinates.
SANITIZED_PROVINCE = "BUENOS AIRES"
SANITIZED_DEPARTMENT_WORD = "Comuna"


def great_circle_km(
    lat1: ColumnLike,
    lon1: ColumnLike,
    lat2: ColumnLike,
    lon2: ColumnLike,
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance in the atan2 form, stable for near and for opposite points."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    dlon = F.radians(as_column(lon2)) - F.radians(as_column(lon1))
    return arc_km((F.sin(phi1), F.cos(phi1)), (F.sin(phi2), F.cos(phi2)), dlon, radius_km)


def arc_km(
    first: tuple[Column, Column], second: tuple[Column, Column], dlon: Column, radius_km: float = EARTH_RADIUS_KM
) -> Column:
    """``great_circle_km`` of two points whose latitudes' sine and cosine are at hand."""
    (sin1, cos1), (sin2, cos2) = first, second
    east = cos2 * F.sin(dlon)
    north = cos1 * sin2 - sin1 * cos2 * F.cos(dlon)
    along = sin1 * sin2 + cos1 * cos2 * F.cos(dlon)
    return F.atan2(F.sqrt(east * east + north * north), along) * radius_km


def unit_vector(lat: ColumnLike, lon: ColumnLike) -> tuple[Column, Column, Column]:
    phi, lam = F.radians(as_column(lat)), F.radians(as_column(lon))
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def is_unreliable(province: ColumnLike, department: ColumnLike) -> Column:
    return F.coalesce(
        (as_column(province) == SANITIZED_PROVINCE)
        & as_column(department).contains(SANITIZED_DEPARTMENT_WORD),
        F.lit(False),
    )


def sanitize_geo(
    province: ColumnLike,
    department: ColumnLike = "desc_departamento_geo",
    lat: ColumnLike = "latitud",
    lon: ColumnLike = "longitud",
) -> dict[str, Column]:
    """Zero the coordinates and drop the department where they cannot be trusted."""
    bad = is_unreliable(province, department)
    return {
        "latitud": F.when(bad, F.lit(0.0)).otherwise(as_column(lat)),
        "longitud": F.when(bad, F.lit(0.0)).otherwise(as_column(lon)),
        "desc_departamento_geo": F.when(~bad, as_column(department)),
    }
