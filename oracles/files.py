"""SQL for file round trips and counts."""

from oracles.events import (
    ALL, COLUMNS, E, ITEM_BASE, ITEM_COLUMNS, O, RATINGS, RATINGS_OUT, USER_BASE, USER_COLUMNS, bots, cold, dropped, eligible,
    jittered, nulled, profile, unit,
)

SHARDS = f"""WITH {E} SELECT event_id, event_time, user_id, item_id, split_part(user_session, '-', 2) AS table_suffix
FROM ev WHERE split_part(user_session, '-', 2) BETWEEN '20240105' AND '20240114'"""

# The whole build, stage by stage; ``event_id`` is the row id of both sources.
KEYED_O = O.replace("SELECT epoch_us", "SELECT 'o' || l_orderkey || '-' || l_linenumber AS event_id, epoch_us", 1)
BUILD = f"""{E}, {KEYED_O},
src AS (SELECT 'b' || event_id AS event_id, {COLUMNS} FROM ev UNION ALL SELECT event_id, {COLUMNS} FROM oev),
{profile('src')},
en AS (SELECT * REPLACE (CASE WHEN user_session IS NULL OR event_time IS NULL THEN 0 ELSE COALESCE(LEAST(GREATEST(
    LEAD(event_time) OVER (PARTITION BY user_session ORDER BY event_time, event_id) - event_time, 0), 1800000), 0) END
    AS engagement_time_msec) FROM pf),
{nulled('en')}, {cold('nu')}, warm AS (SELECT * FROM nu WHERE item_id NOT IN (SELECT item_id FROM cold)),
{jittered('warm')}, {dropped('ji', 0.08)}, {bots('dr', 0.05)},
dm AS (SELECT * FROM dr UNION ALL BY NAME SELECT * FROM fl),
{eligible('dm')},
sided AS (SELECT *, CASE WHEN user_id IN (SELECT user_id FROM tu) THEN 'test' ELSE 'train' END AS side FROM dm WHERE user_id IS NOT NULL),
train AS (SELECT * FROM sided WHERE side = 'train')"""


def one(name: str, query: str) -> str:
    return f"SELECT '{name}' AS metric, ({query})::BIGINT AS n"


COUNTS = " UNION ALL ".join([
    one("n_events_raw", "SELECT COUNT(*) FROM src"), one("n_events_train", "SELECT COUNT(*) FROM train"),
    one("n_events_test", "SELECT COUNT(*) FROM sided WHERE side = 'test'"),
    one("n_users_train", "SELECT COUNT(DISTINCT user_id) FROM train"),
    one("n_users_test", "SELECT COUNT(DISTINCT user_id) FROM sided WHERE side = 'test'"),
    one("n_items_catalog", "SELECT COUNT(DISTINCT item_id) FROM sided"),
    one("n_cold_items", "SELECT COUNT(*) FROM cold"),
    one("n_null_items", f"SELECT COUNT(DISTINCT item_id) FROM src WHERE {unit('null-item', 'item_id')} < 0.25"),
    one("n_dropped_no_item", "SELECT COUNT(*) FROM src WHERE item_id IS NULL"),
    one("n_bot_events", "SELECT COUNT(*) FROM fl"),
    one("n_dropped_no_user", "SELECT COUNT(*) FROM dm WHERE user_id IS NULL"),
])


def features() -> str:
    """Both feature tables in one, each with its encodings."""
    items, users = ITEM_BASE.replace("FROM al", "FROM sided"), USER_BASE.replace("FROM al", "FROM train")
    def index(table: str, columns: dict[str, str]) -> str:
        return ", ".join(
            f"COALESCE((SELECT COUNT(DISTINCT x.{c}) FROM {table} x WHERE x.{c} <= t.{c}), 0) * (t.{c} IS NOT NULL)::INT AS {out}"
            for c, out in columns.items()
        )
    return (
        f"{items}, {users}, fi AS (SELECT *, item_id IN (SELECT item_id FROM cold) AS is_cold, {index('it', ITEM_COLUMNS)} FROM it t), "
        f"fu AS (SELECT *, {index('us', USER_COLUMNS)} FROM us t) SELECT * REPLACE (COALESCE(is_cold, FALSE) AS is_cold) FROM (SELECT * FROM fi UNION ALL BY NAME SELECT * FROM fu)"
    )


MARK = "(SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 6 HOUR FROM events)"

FILE_SQL = {
    "csv_round_trip": "SELECT * FROM orders",
    "date_shards": SHARDS,
    "flat_date_shards": SHARDS,
    "id_list_json": f"WITH {O}, {cold('oev')} SELECT item_id FROM cold",
    "encoder_json": "SELECT 'p_name' AS encoder, p_name AS value, DENSE_RANK() OVER (ORDER BY p_name) AS idx FROM (SELECT DISTINCT p_name FROM part) UNION ALL SELECT 'p_brand', p_brand, DENSE_RANK() OVER (ORDER BY p_brand) FROM (SELECT DISTINCT p_brand FROM part)",
    "audit_outputs": f"WITH {E}, {O} SELECT 'behavior' AS name, TRUE AS exists, COUNT(*) AS rows, TRUE AS stored FROM ev UNION ALL SELECT 'orders', TRUE, COUNT(*), TRUE FROM oev UNION ALL SELECT 'missing', FALSE, NULL, FALSE",
    "manifest_counts": f"WITH {E}, {O}, {ALL} SELECT 'n_events_train' AS metric, COUNT(*) AS n FROM ev UNION ALL SELECT 'n_events_test', COUNT(*) FROM oev UNION ALL SELECT 'n_users_train', COUNT(DISTINCT user_id) FROM ev UNION ALL SELECT 'n_users_test', COUNT(DISTINCT user_id) FROM oev UNION ALL SELECT 'n_items_catalog', COUNT(DISTINCT item_id) FROM al",
    "stream_arrivals": f"WITH {E} SELECT event_id, {COLUMNS} FROM ev",
    "build_dataset": f"WITH {BUILD} {COUNTS}",
    "build_interactions": f"WITH {BUILD} SELECT * RENAME (event_id AS row_key) FROM sided",
    "build_ratings": f"WITH {BUILD}, {RATINGS.format(src='train')} {RATINGS_OUT}",
    "build_features": f"WITH {BUILD}, {features()}",
    "stream_window_counts": f"""SELECT * FROM (SELECT date_trunc('day', ts) AS window_start, event_type, COUNT(*) AS n,
        date_trunc('day', ts) + INTERVAL 1 DAY AS window_end FROM events GROUP BY 1, 2, 4) WHERE window_end <= {MARK}""",
    "stream_sessions": f"""WITH g AS (SELECT user_id, ts, CASE WHEN ts - LAG(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, ts, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
        SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL 2 HOUR AS window_end, user_id, COUNT(*) AS n FROM s
        GROUP BY user_id, k HAVING MAX(ts) + INTERVAL 2 HOUR <= {MARK}""",
}
