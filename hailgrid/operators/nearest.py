"""Points to modelled zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hailgrid.functions.geo import in_box, squared, zone_id, zone_x, zone_y
from hailgrid.operators.sizes import broadcast_within
from hailgrid.params import RideParams

# A centre is three numbers in a struct with its offsets; all lists together may take this much.
CENTRE_BYTES = 48
MAX_LIST_BYTES = 64 << 20


def unmodelled_points(points: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """Points (lon, lat) whose own cell is not a modelled zone."""
    own = points.withColumn("zone_id", zone_id("lon", "lat", params.grid))
    return own.join(broadcast_within(zones.select("zone_id"), params.max_zones), "zone_id", "left_anti")


def cell_candidates(zones: DataFrame, params: RideParams, cells: DataFrame | None = None) -> DataFrame:
    """For every grid cell, or every one of ``cells``, the zones that can be nearest to some point of it.

    A zone drops out if even its smallest distance to the cell exceeds another
    zone's largest one. Distances are in half cells, hence exact integers. Where
    one zone remains, as in a modelled cell, it stands in ``only`` and the list
    is null, so that most points carry no list at all.
    """
    grid = params.grid
    if cells is None:
        number = F.floor(F.col("id") / grid.n_y) * grid.stride + F.col("id") % grid.n_y
        cells = zones.sparkSession.range(grid.n_cells).select(number.alias("cell"))
    cells = cells.withColumn("centres", _centres(zones))

    def apart(axis, centre) -> Column:
        return F.abs(axis(centre.zone_id, grid.stride) - axis(F.col("cell"), grid.stride)) * 2

    def farthest(centre) -> Column:
        return squared(apart(zone_x, centre) + 1) + squared(apart(zone_y, centre) + 1)

    def closest(centre) -> Column:
        none = F.lit(0)
        return squared(F.greatest(apart(zone_x, centre) - 1, none)) + squared(
            F.greatest(apart(zone_y, centre) - 1, none)
        )

    reach = F.array_min(F.transform("centres", farthest))
    possible = F.filter("centres", lambda centre: closest(centre) <= F.col("reach"))
    modelled = F.exists("centres", lambda centre: centre.zone_id == F.col("cell"))
    first = F.get("possible", F.lit(0)).zone_id
    return (
        cells.withColumns({"reach": reach, "modelled": modelled})
        .withColumn("possible", possible)
        .withColumn(
            "only", F.when(F.col("modelled"), F.col("cell")).when(F.size("possible") == 1, first)
        )
        .select("cell", "modelled", "only", F.when(F.col("only").isNull(), F.col("possible")).alias("candidates"))
    )


def _centres(zones: DataFrame) -> Column:
    return zones.agg(F.sort_array(F.collect_list(F.struct("zone_id", "lon", "lat")))).scalar()


def nearest_zone(points: DataFrame, zones: DataFrame, params: RideParams) -> DataFrame:
    """The modelled zone of every point: its own cell, else the zone with the nearest centre.

    Each point looks its cell up in a table with one row per grid cell and
    compares the few zones listed there, so no point is ever paired with all
    zones. Only a point outside the box goes through all of them. Equal
    distances go to the smaller zone id. A point without both coordinates (null
    or NaN) has no zone.

    The table is broadcast if even a list of all zones in every cell would stay
    small. Otherwise it holds the cells that points fall in and is joined like
    any other table, whatever the size of the grid.
    """
    grid = params.grid
    lon, lat = F.col("lon"), F.col("lat")
    known = ~(F.isnan(F.coalesce(lon, F.lit(float("nan")))) | F.isnan(F.coalesce(lat, F.lit(float("nan")))))
    own = points.withColumn("cell", F.when(known & in_box("lon", "lat", grid), zone_id("lon", "lat", grid)))
    if grid.n_cells * params.max_zones * CENTRE_BYTES <= MAX_LIST_BYTES:
        listed = F.broadcast(cell_candidates(zones, params))
    else:
        listed = cell_candidates(zones, params, own.select("cell").filter("cell IS NOT NULL").distinct())
    choices = F.when(known & F.col("only").isNull(), F.coalesce("candidates", _centres(zones)))

    def offer(centre) -> Column:
        distance = squared(centre.lon - lon) + squared(centre.lat - lat)
        return F.struct(distance.alias("d2"), centre.zone_id.alias("zone_id"))

    nearest = F.array_min(F.transform("choices", offer)).zone_id
    return (
        own.join(listed, "cell", "left")
        .withColumn("choices", choices)
        .select(
            *points.columns,
            F.coalesce("modelled", F.lit(False)).alias("modelled"),
            F.coalesce("only", nearest).alias("zone_id"),
        )
    )
