"""Reference SQL for the registered queries, run by another engine over the same tables."""

from oracles.events import EVENT_SQL
from oracles.files import FILE_SQL
from oracles.shop import SHOP_SQL
from oracles.retail import RETAIL_SQL
from oracles.ledger import LEDGER_SQL
from oracles.analytics import ANALYTICS_SQL
from oracles.routes import ROUTE_SQL
from oracles.trends import TREND_SQL

ALL_SQL = {**EVENT_SQL, **SHOP_SQL, **RETAIL_SQL, **LEDGER_SQL, **ANALYTICS_SQL, **ROUTE_SQL, **TREND_SQL, **FILE_SQL}
