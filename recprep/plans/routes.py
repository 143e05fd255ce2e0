"""Taxi x area dataset from trips; taxis and pickup areas are customers, dropoff areas products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.functions import numeric as num
from recprep.functions.text import first_below, first_like
from recprep.functions.times import days_between, days_until, local_parts
from recprep.operators.keyed import (
    dimension,
    distinct_counts,
    m_avg,
    m_count,
    m_max,
    m_min,
    m_small_domain,
    m_sum,
    two_level,
)
from recprep.plans.core import CUSTOMER, PRODUCT, interaction_dataset

# --- Fixed values: company classes, area classes, trip buckets, thresholds. ---
COMPANIES = [
    (("%Flash%",), "Flash Cab"),
    (("%Checker%",), "Checker"),
    (("%Yellow%",), "Yellow Cab"),
    (("%Medallion%",), "Medallion"),
]
VEHICLES = [(("%Flash%", "%Checker%"), "Standard"), (("%Yellow%",), "Premium")]
NAMED_AREAS = {76: "O'Hare Airport", 32: "Downtown", 8: "Loop"}
AREA_RANGES = [(1, 10, "Central"), (11, 30, "North"), (31, 50, "South"), (51, 77, "West")]
DISTANCES = [(1, "Short"), (5, "Medium"), (15, "Long")]
FARES = [(10, "Low Fare"), (25, "Medium Fare"), (50, "High Fare")]
PAYMENTS = {"Credit Card": "Card", "Cash": "Cash", "Mobile": "Mobile", "Dispute": "Dispute"}
ROUTES = [(2, "Short"), (10, "Medium"), (25, "Long")]
LONGEST, DEAREST, OTHER = "Extra Long", "Premium Fare", "Other"
FREQUENT_TRIPS, HIGH_TOTAL, HIGH_TIP = 5, 50, 20
# --- End of fixed values. ---

START = "trip_start_timestamp"
DEGREES = 6  # decimal places kept of a coordinate


def area_class(area: Column) -> Column:
    out = None
    for number, label in NAMED_AREAS.items():
        out = F.when(area == number, F.lit(label)) if out is None else out.when(area == number, F.lit(label))
    for low, high, label in AREA_RANGES:
        out = out.when(area.between(low, high), F.lit(label))
    return out.otherwise(F.lit(OTHER))


def taxi_demographics(trips: DataFrame) -> DataFrame:
    """Taxi: company, company and vehicle class, activity and revenue."""
    known = trips.where(F.col("taxi_id").isNotNull()).select(
        "*", F.col("taxi_id").alias(CUSTOMER), F.col("company").alias("customer_company")
    )
    measures = [
        m_min("first_trip_timestamp", START), m_max("last_trip_timestamp", START), m_count("total_trips"),
        m_avg("avg_trip_miles", "trip_miles"), m_avg("avg_trip_seconds", "trip_seconds"),
        m_sum("total_fare", "fare"), m_sum("total_tips", "tips"), m_sum("total_tolls", "tolls"),
        m_sum("total_extras", "extras"), m_sum("total_revenue", "trip_total"),
    ]
    company = F.col("customer_company")
    return dimension(known, [CUSTOMER], ["customer_company"], measures).withColumns({
        "company_category": first_like(company, COMPANIES, OTHER),
        "vehicle_type": first_like(company, VEHICLES, "Regular"),
    })


def pickup_areas(trips: DataFrame) -> DataFrame:
    """Pickup area: class, mean position, trips, means and revenue."""
    area = F.col("pickup_community_area")
    out = trips.where(area.isNotNull()).groupBy(area.alias(CUSTOMER)).agg(
        num.fixed_avg("pickup_latitude", DEGREES).alias("avg_latitude"),
        num.fixed_avg("pickup_longitude", DEGREES).alias("avg_longitude"),
        F.count("*").alias("total_trips_from_area"),
        num.fixed_avg("trip_miles").alias("avg_trip_miles_from_area"),
        num.fixed_avg("fare").alias("avg_fare_from_area"),
        num.fixed_sum("trip_total").alias("total_revenue_from_area"),
    )
    return out.withColumn("area_category", area_class(F.col(CUSTOMER)))


def dropoff_products(trips: DataFrame) -> DataFrame:
    """Dropoff area: class, mean position, popularity, distinct taxis and sources."""
    area = F.col("dropoff_community_area")
    rows = trips.where(area.isNotNull()).withColumn(PRODUCT, area)
    out = rows.groupBy(PRODUCT).agg(
        num.fixed_avg("dropoff_latitude", DEGREES).alias("avg_latitude"),
        num.fixed_avg("dropoff_longitude", DEGREES).alias("avg_longitude"),
        F.count("*").alias("total_trips_to_area"),
        num.fixed_avg("trip_miles").alias("avg_trip_miles_to_area"),
        num.fixed_avg("fare").alias("avg_fare_to_area"),
        num.fixed_sum("trip_total").alias("total_revenue_to_area"),
    )
    reach = distinct_counts(
        rows, [PRODUCT], {"unique_taxis_serving": "taxi_id", "unique_pickup_areas": "pickup_community_area"}
    )
    return out.join(reach, PRODUCT).withColumn("product_category", area_class(F.col(PRODUCT)))


def trip_categories(trips: DataFrame) -> DataFrame:
    """Trips and means per distance, fare and payment bucket."""
    pay = F.lit(OTHER)
    for name, label in reversed(PAYMENTS.items()):
        pay = F.when(F.col("payment_type") == name, F.lit(label)).otherwise(pay)
    return trips.groupBy(
        first_below(F.col("trip_miles"), DISTANCES, LONGEST).alias("trip_distance_category"),
        first_below(F.col("fare"), FARES, DEAREST).alias("fare_category"),
        pay.alias("payment_category"),
    ).agg(
        F.count("*").alias("trip_count"),
        num.fixed_avg("fare").alias("avg_fare"),
        num.fixed_avg("trip_miles").alias("avg_distance"),
        num.fixed_avg("trip_seconds").alias("avg_duration"),
    )


def _pair_measures() -> list:
    return [
        m_count("trip_count"),
        m_avg("avg_fare", "fare"), m_avg("avg_tips", "tips"), m_avg("avg_tolls", "tolls"),
        m_avg("avg_extras", "extras"), m_avg("avg_trip_total", "trip_total"),
        m_avg("avg_distance_miles", "trip_miles"), m_avg("avg_duration_seconds", "trip_seconds"),
        m_min("first_trip_timestamp", START), m_max("last_trip_timestamp", START),
    ]


def taxi_dropoff_interactions(trips: DataFrame) -> DataFrame:
    """(taxi, dropoff area): trips, means, most frequent payment (ties: by name), hours, days."""
    rows = trips.where(F.col("taxi_id").isNotNull() & F.col("dropoff_community_area").isNotNull()).select(
        "*", F.col("taxi_id").alias(CUSTOMER), F.col("dropoff_community_area").alias(PRODUCT)
    )
    common = F.min(F.when(F.col("payment_type").isNotNull(), F.struct(-F.col("_trip_count"), "payment_type")))
    return two_level(
        rows, [CUSTOMER, PRODUCT], ["payment_type"],
        [
            *_pair_measures(),
            m_small_domain("hours_active", F.hour(START)),
            m_small_domain("days_active", F.dayofweek(START)),
        ],
        [common["payment_type"].alias("primary_payment_type")],
        spread=True,
    )


def area_interactions(trips: DataFrame) -> DataFrame:
    """(pickup area, dropoff area): trips, means, distinct taxis and companies."""
    rows = trips.where(
        F.col("pickup_community_area").isNotNull() & F.col("dropoff_community_area").isNotNull()
    ).select(
        "*", F.col("pickup_community_area").alias(CUSTOMER), F.col("dropoff_community_area").alias(PRODUCT)
    )
    keys = [CUSTOMER, PRODUCT]
    taxis = [F.count("taxi_id").alias("unique_taxis")]
    per_taxi = two_level(rows, keys, ["taxi_id"], _pair_measures(), taxis, spread=True)
    return per_taxi.join(distinct_counts(rows, keys, {"unique_companies": "company"}), keys)


def customer_behavior(trips: DataFrame) -> DataFrame:
    """Taxi totals, span in days and distinct dropoff areas."""
    rows = trips.where(F.col("taxi_id").isNotNull()).withColumn(CUSTOMER, F.col("taxi_id"))
    out = two_level(
        rows, [CUSTOMER], ["dropoff_community_area"],
        [
            m_count("total_trips"), m_avg("avg_fare", "fare"), m_avg("avg_tips", "tips"),
            m_avg("avg_distance", "trip_miles"), m_avg("avg_duration", "trip_seconds"),
            m_sum("total_fare", "fare"), m_sum("total_tips", "tips"), m_sum("total_revenue", "trip_total"),
            m_min("first_trip_timestamp", START), m_max("last_trip_timestamp", START),
        ],
        [F.count("dropoff_community_area").alias("unique_dropoff_areas")],
    )
    span = days_between(F.col("last_trip_timestamp"), F.col("first_trip_timestamp"))
    return out.withColumn("days_active", span)


def _main_columns(as_of: str) -> list[Column]:
    c = F.col

    def zero(name: str, kind: str = "double") -> Column:
        return num.or_zero(name, kind)

    tip = num.safe_div("t.avg_tips", "t.avg_fare") * 100
    last = F.coalesce("t.last_trip_timestamp", "a.last_trip_timestamp")
    miles, seconds, total = c("t.avg_distance_miles"), c("t.avg_duration_seconds"), c("t.avg_trip_total")
    engagement = (
        zero("t.trip_count", "long") * 0.3 + zero("t.avg_trip_total") * 0.3 + zero("t.avg_distance_miles") * 0.2
        + F.coalesce(tip, F.lit(0.0)) * 0.2
    )
    means = ("avg_fare", "avg_tips", "avg_tolls", "avg_extras", "avg_trip_total", "avg_distance_miles", "avg_duration_seconds")
    return [
        c(CUSTOMER), c(PRODUCT), c("customer_company"), c("company_category").alias("customer_company_category"),
        c("product_category"), c("vehicle_type").alias("customer_vehicle_type"),
        zero("d.total_trips", "long").alias("customer_total_trips"),
        zero("avg_trip_miles").alias("customer_avg_trip_miles"),
        zero("d.total_revenue").alias("customer_total_revenue"),
        c("avg_fare_to_area").alias("product_avg_fare"), c("avg_trip_miles_to_area").alias("product_avg_distance"),
        c("total_revenue_to_area").alias("product_total_revenue"),
        c("unique_taxis_serving").alias("product_unique_customers"),
        c("unique_pickup_areas").alias("product_unique_sources"),
        zero("t.trip_count", "long").alias("interaction_count"),
        *[zero(f"t.{m}").alias(m) for m in means],
        tip.alias("avg_tip_percentage"),
        c("b.avg_fare").alias("customer_avg_fare"), c("b.days_active").alias("customer_days_active"),
        c("unique_dropoff_areas").alias("customer_unique_products"),
        *local_parts(last),
        F.coalesce("primary_payment_type", F.lit("")).alias("primary_payment_type"),
        zero("hours_active", "long").alias("hours_active"), zero("t.days_active", "long").alias("days_active"),
        days_until(as_of, last).alias("days_since_last_interaction"),
        num.flag(c("t.trip_count") > FREQUENT_TRIPS).alias("is_frequent_route"),
        num.flag(total > HIGH_TOTAL).alias("is_high_value_route"),
        num.flag(tip > HIGH_TIP).alias("is_high_tip_route"),
        engagement.alias("engagement_score"),
        F.when((seconds > 0) & (miles > 0), miles / (seconds / 3600)).otherwise(F.lit(0.0)).alias("speed_mph"),
        F.when(miles > 0, total / miles).otherwise(F.lit(0.0)).alias("value_per_mile"),
        first_below(miles, ROUTES, LONGEST).alias("route_distance_category"),
    ]


def taxi_area_dataset(trips: DataFrame, as_of: str, ordered: bool = False) -> DataFrame:
    """(taxi or pickup area, dropoff area): both matrices in one full outer join.

    Customer ids are text, since taxis and areas share the column. Measures come from the taxi
    matrix; an area pair without a taxi of that id keeps zeros, as in the source query.
    """
    taxis = taxi_dropoff_interactions(trips).withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))
    areas = area_interactions(trips).withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))
    own = taxi_demographics(trips).withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))
    behavior = customer_behavior(trips).withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))
    wide = taxis.alias("t").join(areas.alias("a"), [CUSTOMER, PRODUCT], "full")
    wide = wide.withColumn("_taxi", F.when(F.col("t.trip_count").isNotNull(), F.col(CUSTOMER)))
    return interaction_dataset(
        wide,
        [
            (own.withColumnRenamed(CUSTOMER, "_taxi").alias("d"), ["_taxi"], "left"),
            (dropoff_products(trips).alias("p"), [PRODUCT], "left"),
            (behavior.withColumnRenamed(CUSTOMER, "_taxi").alias("b"), ["_taxi"], "left"),
        ],
        _main_columns(as_of),
        name=None,  # both matrices keep their own aliases
        ordered=[F.col(CUSTOMER), F.col(PRODUCT)] if ordered else None,
    )
