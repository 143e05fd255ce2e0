"""Queries over the analytics exports.

A full dataset reads its source many times, so the derived source is written once first.
"""

from __future__ import annotations

from recprep.plans import ga4, ua
from recprep.session import materialize
from recprep.sources.standins import ga4_events, ua_sessions


def ga_customer_demographics(spark, sf_dir):
    return ga4.customer_demographics(ga4_events(spark, sf_dir))


def ga_product_features(spark, sf_dir):
    return ga4.product_features(ga4_events(spark, sf_dir))


def ga_interactions(spark, sf_dir):
    return ga4.customer_product_interactions(ga4_events(spark, sf_dir))


def ga_transactions(spark, sf_dir):
    return ga4.ecommerce_transactions(ga4_events(spark, sf_dir))


def ga_customer_behavior(spark, sf_dir):
    return ga4.customer_behavior(ga4_events(spark, sf_dir))


def ga_main(spark, sf_dir):
    return ga4.customer_item_dataset(materialize(ga4_events(spark, sf_dir)))


def ua_customer_demographics(spark, sf_dir):
    return ua.customer_demographics(ua_sessions(spark, sf_dir))


def ua_product_features(spark, sf_dir):
    return ua.product_features(ua_sessions(spark, sf_dir))


def ua_interactions(spark, sf_dir):
    return ua.customer_product_interactions(ua_sessions(spark, sf_dir))


def ua_transactions(spark, sf_dir):
    return ua.transaction_data(ua_sessions(spark, sf_dir))


def ua_customer_behavior(spark, sf_dir):
    return ua.customer_behavior(ua_sessions(spark, sf_dir))


def ua_main(spark, sf_dir):
    return ua.visitor_product_dataset(materialize(ua_sessions(spark, sf_dir)))


ANALYTICS_QUERIES = {
    f.__name__: f
    for f in (
        ga_customer_demographics, ga_product_features, ga_interactions, ga_transactions, ga_customer_behavior,
        ga_main, ua_customer_demographics, ua_product_features, ua_interactions, ua_transactions,
        ua_customer_behavior, ua_main,
    )
}
