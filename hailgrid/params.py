"""Parameters of the spatial grid and of the jobs built on it."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import floor

# A zone id is x * stride + y, so a grid may be at most this many rows high.
ZONE_STRIDE = 100


@dataclass(frozen=True)
class GridSpec:
    """Rectangular cells over a longitude/latitude box.

    The box is closed on every side, so its upper edges open one more column
    and one more row of cells.
    """

    lon_min: float = -74.05
    lon_max: float = -73.70
    lat_min: float = 40.55
    lat_max: float = 40.95
    cell: float = 0.05
    stride: int = ZONE_STRIDE

    def __post_init__(self) -> None:
        if self.n_y > self.stride:
            raise ValueError(f"{self.n_y} grid rows do not fit into zone ids of stride {self.stride}")

    @property
    def n_x(self) -> int:
        return floor((self.lon_max - self.lon_min) / self.cell) + 1

    @property
    def n_y(self) -> int:
        return floor((self.lat_max - self.lat_min) / self.cell) + 1

    @property
    def n_cells(self) -> int:
        """Upper bound on the number of distinct zones, whatever the size of the trip data."""
        return self.n_x * self.n_y


COARSE_GRID = GridSpec()
FINE_GRID = GridSpec(cell=0.01)


@dataclass(frozen=True)
class RideParams:
    """Settings shared by cleaning, features, forecasting and allocation."""

    grid: GridSpec = field(default=FINE_GRID)
    top_zones: int = 200
    min_seconds: int = 60
    max_seconds: int = 10800
    train_end: str = "2016-06-01"
    fleet: int = 3000
    trips_per_driver: float = 2.0

    @property
    def max_zones(self) -> int:
        """Upper bound on the number of modelled zones."""
        return min(self.top_zones, self.grid.n_cells)
