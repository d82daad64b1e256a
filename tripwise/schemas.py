"""Schemas of the text files, fixed by position (files carry no header)."""

from __future__ import annotations

WEATHER = "dt string, temp double, rain double, snow double, wspd double"

TAXI_LABELLED = ("dt string, time string, dur double, lat1 double, lon1 double, lat2 double, lon2 double, "
                 "psg double, trip_distance double")
TAXI_UNLABELLED = "dt string, time string, lat1 double, lon1 double, lat2 double, lon2 double, psg double"

BIKE_LABELLED = ("dt string, time string, dur double, id1 double, lat1 double, lon1 double, id2 double, "
                 "lat2 double, lon2 double, yr double, gdr double")
BIKE_UNLABELLED = ("dt string, time string, id1 double, lat1 double, lon1 double, id2 double, "
                   "lat2 double, lon2 double, yr double, gdr double")

ZONES = "location_id int, borough string, zone string, lat double, lon double"

CLEAN_TAXI = ("pck_date string, pck_hms string, Duration bigint, pickup_latitude double, pickup_longitude double, "
              "dropoff_latitude double, dropoff_longitude double, passenger_count bigint, trip_distance double")


def trips_schema(dataset: str, labelled: bool) -> str:
    d = dataset.lower()
    if d == "taxi":
        return TAXI_LABELLED if labelled else TAXI_UNLABELLED
    if d == "bike":
        return BIKE_LABELLED if labelled else BIKE_UNLABELLED
    raise ValueError(f"dataset must be taxi or bike, not {dataset!r}")
