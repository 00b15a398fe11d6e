"""Declared schemas, as DDL strings. Nothing is inferred from data."""

# Columns a raw trips CSV must have; text is cast by the reader.
RAW_TRIP_TYPES = {
    "id": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
    "passenger_count": "int",
    "trip_duration": "int",
}

#: Tables that are one side of another table.
FOLDERS = {"clean": "checked_trips/kept=true", "rejected": "checked_trips/kept=false"}

RESULT_SCHEMAS = {
    "hourly_demand": "pickup_hour int, total_trips long",
    "daily_demand": "day_number int, day_name string, total_trips long",
    "average_duration": "average_duration_minutes double",
    "average_passengers": "average_passengers double",
    "quality_counts": "total_records long, valid_records long, removed_records long",
    "zone_demand": "zone_id long, total_trips long, avg_trip_duration_minutes double, avg_passengers double",
    "demand_predictions": "pickup_hour int, day_of_week int, total_trips long, prediction double",
    "driver_allocation": (
        "pickup_hour int, day_of_week int, predicted_demand double, required_drivers long, "
        "available_drivers int, driver_difference long, allocation_status string"
    ),
    "zones": "zone_id long, total_trips long, avg_trip_min double, lon double, lat double",
    "timeline": "first_hour timestamp_ntz, last_hour timestamp_ntz",
    "hist": "zone_id long, dow int, hour int, hist_mean double",
    "supply_proxy": "zone_id long, dow int, hour int, avg_dropoffs double, dropoffs long",
    "demand_profile": "dow int, hour int, avg_city_trips double",
    "zone_hour_batches": "zone_id long, ts timestamp_ntz, demand long, dropoffs long, seconds long, date date, batch string",
    "zone_hour_merged": "zone_id long, ts timestamp_ntz, demand long, dropoffs long, seconds long, date date",
    "slot_merged": "zone_id long, hour int, demand long, dropoffs long, seconds long, busy_hours long, dow int",
    "clean_counts": "rule string, trips long",
    "metrics": "model string, mae double, rmse double",
    "metric_gain": "baseline string, model_mae double, baseline_mae double, gain double",
    "test_preds": "zone_id long, ts timestamp_ntz, demand long, prediction double, hist_mean double",
    "pred_grid": "zone_id long, dow int, hour int, hist_mean double, prediction double",
    "allocation": (
        "dow int, hour int, zone_id long, prediction double, needed long, current long, "
        "assigned long, gap long, short_now long, short_after long, variant string"
    ),
    "allocation_moves": "from_zone long, to_zone long, drivers long, km double, dow int, hour int, variant string",
}
