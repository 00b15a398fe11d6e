"""Grid geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hailgrid.params import ZONE_STRIDE, GridSpec

# Kilometres per degree at the latitude of New York, and the plain average.
KM_PER_DEG_LON = 84.4
KM_PER_DEG_LAT = 111.2
KM_PER_DEG = 111


def in_box(lon: str, lat: str, grid: GridSpec) -> Column:
    """True for points inside the box or on its edge. Null coordinates give null."""
    return F.expr(
        f"{lon} BETWEEN {grid.lon_min}D AND {grid.lon_max}D AND {lat} BETWEEN {grid.lat_min}D AND {grid.lat_max}D"
    )


def zone_id(lon: str, lat: str, grid: GridSpec) -> Column:
    return F.expr(
        f"floor(({lon} - {grid.lon_min}D) / {grid.cell}D) * {grid.stride}L"
        f" + floor(({lat} - {grid.lat_min}D) / {grid.cell}D)"
    )


def zone_x(zone: Column, stride: int = ZONE_STRIDE) -> Column:
    return F.floor(zone / stride).cast("int")


def zone_y(zone: Column, stride: int = ZONE_STRIDE) -> Column:
    return (zone % stride).cast("int")


def zone_lon(zone: Column, grid: GridSpec) -> Column:
    """Longitude of the cell centre."""
    return F.lit(grid.lon_min) + (zone_x(zone, grid.stride) + F.lit(0.5)) * F.lit(grid.cell)


def zone_lat(zone: Column, grid: GridSpec) -> Column:
    """Latitude of the cell centre."""
    return F.lit(grid.lat_min) + (zone_y(zone, grid.stride) + F.lit(0.5)) * F.lit(grid.cell)


def squared(value: Column) -> Column:
    return value * value


def cell_distance_squared(a: Column, b: Column, stride: int = ZONE_STRIDE) -> Column:
    """Squared distance of two zones in cells: an exact integer, so ties are real ties."""
    return squared(zone_x(a, stride) - zone_x(b, stride)) + squared(zone_y(a, stride) - zone_y(b, stride))


def km_between(a: Column, b: Column, grid: GridSpec) -> Column:
    """Planar distance of two cell centres with separate scales for longitude and latitude."""
    return F.hypot(
        (zone_x(a, grid.stride) - zone_x(b, grid.stride)) * F.lit(grid.cell) * F.lit(KM_PER_DEG_LON),
        (zone_y(a, grid.stride) - zone_y(b, grid.stride)) * F.lit(grid.cell) * F.lit(KM_PER_DEG_LAT),
    )


def degree_km_between(a: Column, b: Column, grid: GridSpec) -> Column:
    """Distance in degrees times one flat scale, as the second allocation variant reports it."""
    return F.sqrt(cell_distance_squared(a, b, grid.stride).cast("double")) * F.lit(grid.cell) * F.lit(KM_PER_DEG)
