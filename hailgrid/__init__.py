"""Ride-demand analytics on Spark: demand reports, forecasting features and driver allocation."""

from hailgrid.params import COARSE_GRID, FINE_GRID, GridSpec, RideParams

__all__ = ["COARSE_GRID", "FINE_GRID", "GridSpec", "RideParams"]
