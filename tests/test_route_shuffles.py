"""Trips of a pair are shuffled as they are: a partial aggregate of about one row per fine group only widens them."""

import datetime

import pytest

from recprep.plans import routes

TRIPS = (
    "taxi_id string, company string, trip_start_timestamp timestamp, trip_miles double, trip_seconds long, fare double, "
    "tips double, tolls double, extras double, trip_total double, payment_type string, pickup_community_area long, "
    "dropoff_community_area long"
)


def trip(taxi, pay, pickup, dropoff, fare, hour=1):
    at = datetime.datetime(2001, 1, 1, hour)
    return taxi, "c", at, 2.0, 60, fare, 1.0, 0.0, 0.5, fare + 1.5, pay, pickup, dropoff


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(
        [
            trip("a", "Cash", 1, 8, 10.0), trip("a", "Cash", 1, 8, 20.0, 2), trip("a", "Mobile", 1, 8, 30.0),
            trip("a", None, 2, 8, 5.0), trip("b", None, 1, 8, 7.0), trip(None, "Cash", 1, 8, 9.0),
            trip("b", "Cash", None, 8, 1.0), trip("a", "Cash", 1, None, 1.0),
        ],
        TRIPS,
    )


def _dealt(df):
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_COL")


def test_taxi_pairs_are_dealt_once(trips):
    out = routes.taxi_dropoff_interactions(trips)
    assert _dealt(out) == 1
    got = {(r.customer_id, r.product_id): (r.trip_count, r.avg_fare, r.hours_active, r.primary_payment_type) for r in out.collect()}
    assert got == {("a", 8): (4, 16.25, 2, "Cash"), ("b", 8): (2, 4.0, 1, "Cash")}


def test_area_pairs_are_dealt_once(trips):
    out = routes.area_interactions(trips)
    assert _dealt(out) == 1
    got = {(r.customer_id, r.product_id): (r.trip_count, r.avg_fare, r.unique_taxis, r.unique_companies) for r in out.collect()}
    assert got == {(1, 8): (5, 15.2, 2, 1), (2, 8): (1, 5.0, 1, 1)}
