"""Queries over search trends.

A full dataset reads its source many times, so the derived source is written once first.
"""

from __future__ import annotations

from recprep.plans import trends
from recprep.sources.standins import trend_tables

AS_OF = "2002-01-01"


def trend_region_demographics(spark, sf_dir):
    return trends.region_demographics(*trend_tables(spark, sf_dir)[:2])


def trend_term_features(spark, sf_dir):
    return trends.term_features(*trend_tables(spark, sf_dir)[:2])


def trend_interactions(spark, sf_dir):
    return trends.region_term_interactions(*trend_tables(spark, sf_dir)[:2])


def trend_rising_terms(spark, sf_dir):
    return trends.rising_terms(*trend_tables(spark, sf_dir)[2:])


def trend_region_behavior(spark, sf_dir):
    return trends.region_behavior(trends.region_term_interactions(*trend_tables(spark, sf_dir)[:2]))


def trend_main(spark, sf_dir):
    return trends.region_term_dataset(*trend_tables(spark, sf_dir, store=True), as_of=AS_OF)


TREND_QUERIES = {
    f.__name__: f
    for f in (
        trend_region_demographics, trend_term_features, trend_interactions, trend_rising_terms,
        trend_region_behavior, trend_main,
    )
}
