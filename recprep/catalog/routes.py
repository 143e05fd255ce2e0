"""Queries over trips.

A full dataset reads its source many times, so the derived source is written once first.
"""

from __future__ import annotations

from recprep.plans import routes
from recprep.session import materialize
from recprep.sources.standins import taxi_trips

AS_OF = "2002-01-01"


def route_taxi_demographics(spark, sf_dir):
    return routes.taxi_demographics(taxi_trips(spark, sf_dir))


def route_pickup_areas(spark, sf_dir):
    return routes.pickup_areas(taxi_trips(spark, sf_dir))


def route_dropoff_products(spark, sf_dir):
    return routes.dropoff_products(taxi_trips(spark, sf_dir))


def route_trip_categories(spark, sf_dir):
    return routes.trip_categories(taxi_trips(spark, sf_dir))


def route_taxi_interactions(spark, sf_dir):
    return routes.taxi_dropoff_interactions(taxi_trips(spark, sf_dir))


def route_area_interactions(spark, sf_dir):
    return routes.area_interactions(taxi_trips(spark, sf_dir))


def route_customer_behavior(spark, sf_dir):
    return routes.customer_behavior(taxi_trips(spark, sf_dir))


def route_main(spark, sf_dir):
    return routes.taxi_area_dataset(materialize(taxi_trips(spark, sf_dir)), AS_OF)


ROUTE_QUERIES = {
    f.__name__: f
    for f in (
        route_taxi_demographics, route_pickup_areas, route_dropoff_products, route_trip_categories,
        route_taxi_interactions, route_area_interactions, route_customer_behavior, route_main,
    )
}
