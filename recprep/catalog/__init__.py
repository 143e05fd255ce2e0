"""Registered queries: each runs one operator over the check tables."""

from recprep.catalog.analytics import ANALYTICS_QUERIES
from recprep.catalog.events import EVENT_QUERIES
from recprep.catalog.files import FILE_QUERIES
from recprep.catalog.ledger import LEDGER_QUERIES
from recprep.catalog.retail import RETAIL_QUERIES
from recprep.catalog.routes import ROUTE_QUERIES
from recprep.catalog.shop import SHOP_QUERIES
from recprep.catalog.trends import TREND_QUERIES

ALL_QUERIES = {
    **EVENT_QUERIES,
    **SHOP_QUERIES,
    **RETAIL_QUERIES,
    **LEDGER_QUERIES,
    **ANALYTICS_QUERIES,
    **ROUTE_QUERIES,
    **TREND_QUERIES,
    **FILE_QUERIES,
}
