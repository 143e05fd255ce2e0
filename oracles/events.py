"""SQL for the unified-event operators."""

from oracles.common import favg

SEED = 20260831
E = """
raw_b AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS event_time,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'purchase'
                    WHEN 'signup' THEN 'remove' END AS event_type,
    'u' || user_id AS user_id, value AS price,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    'u' || user_id || '-' || strftime(ts, '%Y%m%d') AS user_session
  FROM events),
ev AS (
  SELECT event_id, event_time, event_type, user_id, CAST(NULL AS VARCHAR) AS user_pseudo_id,
    'p' || k AS item_id, 'c' || (k % 7) AS category_id, 'cat.' || (k % 13) AS category_code,
    CASE WHEN k % 10 <> 0 THEN 'b' || (k % 11) END AS brand, price, user_session,
    CAST(NULL AS BIGINT) AS engagement_time_msec, CAST(NULL AS VARCHAR) AS device_category,
    CAST(NULL AS VARCHAR) AS geo_province, FALSE AS discount_flag,
    CAST(NULL AS VARCHAR) AS fulfillment_status, CAST(NULL AS DOUBLE) AS customer_ltv,
    CAST(NULL AS VARCHAR) AS age_band
  FROM raw_b)"""
O = """
oev AS (
  SELECT epoch_us(o_orderdate) // 1000 AS event_time, 'purchase' AS event_type, 'u' || o_custkey AS user_id,
    CAST(NULL AS VARCHAR) AS user_pseudo_id, 'p' || l_partkey AS item_id, CAST(NULL AS VARCHAR) AS category_id,
    p_type AS category_code, p_brand AS brand, l_extendedprice AS price, CAST(NULL AS VARCHAR) AS user_session,
    CAST(NULL AS BIGINT) AS engagement_time_msec, CAST(NULL AS VARCHAR) AS device_category,
    CASE c_nationkey WHEN 0 THEN 'ID-JK' WHEN 1 THEN 'ID-JB' WHEN 2 THEN 'ID-JT' WHEN 3 THEN 'ID-JI'
      WHEN 4 THEN 'ID-PA' WHEN 5 THEN 'ID-SN' WHEN 6 THEN 'ID-SU' WHEN 7 THEN 'ID-KI' END AS geo_province,
    l_discount > 0.05 AS discount_flag, o_orderstatus AS fulfillment_status, c_acctbal AS customer_ltv,
    CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN 18 + c_custkey % 60 < 25 THEN '18-24'
      WHEN 18 + c_custkey % 60 < 35 THEN '25-34' WHEN 18 + c_custkey % 60 < 45 THEN '35-44' ELSE '45+' END AS age_band
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey)"""
COLUMNS = (
    "event_time, event_type, user_id, user_pseudo_id, item_id, category_id, category_code, brand, price, "
    "user_session, engagement_time_msec, device_category, geo_province, discount_flag, fulfillment_status, "
    "customer_ltv, age_band"
)
DWELL = """
dw AS (
  SELECT * REPLACE (COALESCE(LEAST(GREATEST(
      LEAD(event_time) OVER (PARTITION BY user_session ORDER BY event_time, event_id) - event_time, 0), 1800000), 0)
      AS engagement_time_msec)
  FROM {src})"""


def unit(salt: str, key: str, seed: int = SEED) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|{salt}|' || {key}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def quarter(salt: str, key: str, index: int, seed: int = SEED) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|{salt}|' || {key}), {1 + 8 * index}, 8) AS BIGINT) / 4294967296.0)"


def steps(draw: str, pairs: list[tuple[float, str]]) -> str:
    """Weighted choice: cumulative (bound, value) pairs, the last bound is open."""
    whens = " ".join(f"WHEN {draw} < {bound!r} THEN '{value}'" for bound, value in pairs[:-1])
    return f"CASE WHEN {draw} IS NULL THEN NULL {whens} ELSE '{pairs[-1][1]}' END"


def running(values, weights):
    total, acc, out = float(sum(weights)), 0.0, []
    for v, w in zip(values, weights):
        acc += w / total
        out.append((acc, v))
    return out


PROVINCES = ["ID-JK", "ID-JB", "ID-JT", "ID-JI", "ID-PA", "ID-SN", "ID-SU", "ID-KI"]
PROVINCE_STEPS = running(PROVINCES, [0.32, 0.21, 0.14, 0.13, 0.04, 0.06, 0.07, 0.03])
DEVICE_STEPS = running(["mobile", "desktop", "tablet"], [0.78, 0.18, 0.04])
PROVINCE_LIST = "[" + ", ".join(f"'{p}'" for p in PROVINCES) + "]"

RATINGS = """
pair AS (
  SELECT COALESCE(user_id, user_pseudo_id) AS user_id, item_id,
    COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS nv, COUNT(CASE WHEN event_type = 'cart' THEN 1 END) AS nc,
    COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS nb, SUM(COALESCE(engagement_time_msec, 0)) AS ms
  FROM {src} WHERE event_type IN ('view', 'cart', 'purchase') GROUP BY 1, 2),
sc AS (SELECT user_id, item_id, nv * 1.0::DOUBLE + nc * 3.0::DOUBLE + nb * 5.0::DOUBLE
         + LOG2(1 + ms / 1000.0::DOUBLE) * 0.5::DOUBLE AS raw FROM pair),
bounds AS (SELECT MIN(raw) AS lo, MAX(raw) AS hi FROM sc)"""
RATINGS_OUT = """SELECT user_id, item_id, ROUND(raw, 6) AS raw_score,
  ROUND(1.0::DOUBLE + 4.0::DOUBLE * (raw - lo) / NULLIF(hi - lo, 0), 3) AS pseudo_rating FROM sc, bounds"""


def profile(src: str) -> str:
    d = "user_session"
    pseudo = ".".join("%s" for _ in range(2))
    part = "CAST(1000000000 + CAST(FLOOR({} * 8999999999) AS BIGINT) AS VARCHAR)"
    parts = [part.format(quarter("session", d, i)) for i in range(2)]
    return f"""
pf AS (
  SELECT * REPLACE (
    COALESCE(user_pseudo_id, {parts[0]} || '.' || {parts[1]}) AS user_pseudo_id,
    COALESCE(device_category, {steps(quarter("session", d, 2), DEVICE_STEPS)}) AS device_category,
    COALESCE(geo_province, {steps(quarter("session", d, 3), PROVINCE_STEPS)}) AS geo_province)
  FROM {src})"""


def cold(src: str) -> str:
    """cold(item_id): exactly round(.15 n) items by hash."""
    u = unit("cold-item", "item_id")
    return f"""
items AS (SELECT DISTINCT item_id FROM {src} WHERE item_id IS NOT NULL),
rk AS (SELECT item_id, ROW_NUMBER() OVER (ORDER BY {u}, item_id) AS rn, COUNT(*) OVER () AS n FROM items),
cold AS (SELECT item_id FROM rk WHERE rn <= round_even(0.15::DOUBLE * n, 0))"""


def nulled(src: str, out: str = "nu") -> str:
    u = unit("null-item", "item_id")
    return f"""
{out} AS (SELECT * REPLACE (
  CASE WHEN {u} < 0.25 THEN NULL ELSE category_code END AS category_code,
  CASE WHEN {u} < 0.25 THEN NULL ELSE brand END AS brand) FROM {src})"""


def jittered(src: str, out: str = "ji") -> str:
    u = unit("jitter", "event_id")
    return f"""
{out} AS (SELECT * REPLACE (event_time + CAST(FLOOR(-LN(1.0 - {u}) * 1000.0::DOUBLE / 0.5) AS BIGINT) AS event_time),
  event_time AS true_event_time FROM {src})"""


def dropped(src: str, rate: float, out: str = "dr") -> str:
    u = unit("cart", "event_id")
    return f"""
{out} AS (SELECT * EXCLUDE (mx) FROM (
  SELECT *, MAX(CASE WHEN event_type = 'purchase' THEN event_time END)
              OVER (PARTITION BY user_id, item_id, user_session) AS mx FROM {src})
  WHERE NOT COALESCE(event_type = 'cart' AND mx > event_time AND {u} < {rate}, FALSE))"""


def bots(src: str, fraction: float) -> str:
    gap = f"FLOOR(LEAST(GREATEST(-LN(1.0 - {quarter('bot-event', 'i', 2)}) * 1000.0::DOUBLE / 150.0, 1), 10))"
    return f"""
facts AS (SELECT CAST(FLOOR({fraction}::DOUBLE * COUNT(*)) AS BIGINT) AS n, MIN(event_time) AS t0 FROM {src}),
nb AS (SELECT n, t0, GREATEST(1, n // 200) AS bots, n // GREATEST(1, n // 200) AS per FROM facts),
bi AS (SELECT i, LEAST(i // per, bots - 1) AS bot, t0 FROM nb, range((SELECT n FROM nb)) r(i)),
bt AS (SELECT i, bot, {unit('bot-event', 'i')} AS u,
    CAST(1 + FLOOR({quarter('bot-event', 'i', 3)} * 9) AS BIGINT) AS dwell,
    t0 + CAST(SUM({gap}) OVER (PARTITION BY bot ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS t FROM bi),
pop AS (SELECT item_id, CAST(round_even(POW(COUNT(*), 0.75::DOUBLE) * 1e6, 0) AS BIGINT) AS w FROM {src}
        WHERE item_id IS NOT NULL GROUP BY 1),
line AS (SELECT item_id, CAST(SUM(w) OVER (ORDER BY substr(md5(item_id), 1, 3), item_id) AS BIGINT) AS hi, w,
    CAST(SUM(w) OVER () AS BIGINT) AS total FROM pop),
bx AS (SELECT bt.*, item_id FROM bt JOIN line ON FLOOR(u * total::DOUBLE) >= hi - w AND FLOOR(u * total::DOUBLE) < hi),
fl AS (SELECT t AS event_time, 'view' AS event_type, CAST(NULL AS VARCHAR) AS user_id,
    'bot_{SEED}_' || bot AS user_pseudo_id, item_id, CAST(NULL AS VARCHAR) AS user_session,
    dwell AS engagement_time_msec, 'desktop' AS device_category,
    {PROVINCE_LIST}[CAST(FLOOR({unit('bot', 'bot')} * 8) AS INT) + 1] AS geo_province, FALSE AS discount_flag,
    t AS true_event_time FROM bx)"""


def eligible(src: str, minimum: int = 5, fraction: float = 0.15) -> str:
    u = unit("split", "user_id")
    return f"""
el AS (SELECT user_id FROM {src} WHERE user_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= {minimum}),
er AS (SELECT user_id, ROW_NUMBER() OVER (ORDER BY {u}, user_id) AS rn, COUNT(*) OVER () AS n FROM el),
tu AS (SELECT user_id FROM er WHERE rn <= FLOOR({fraction}::DOUBLE * n))"""


def first_of(column: str) -> str:
    return (
        f"(ARG_MIN({column}, ROW(COALESCE(event_time, 9223372036854775807), {column}))"
        f" FILTER (WHERE {column} IS NOT NULL)) AS {column}"
    )


def encoded(columns: dict[str, str], src: str, rest: str) -> str:
    maps = "".join(
        f"m_{c} AS (SELECT {c}, DENSE_RANK() OVER (ORDER BY {c}) AS idx FROM (SELECT DISTINCT {c} FROM {src} WHERE {c} IS NOT NULL)),\n"
        for c in columns
    ).rstrip(",\n")
    picks = ", ".join(f"COALESCE(m_{c}.idx, 0) AS {out}" for c, out in columns.items())
    joins = " ".join(f"LEFT JOIN m_{c} ON {src}.{c} = m_{c}.{c}" for c in columns)
    return f"{maps}\nSELECT {rest}, {picks} FROM {src} {joins}"


ITEM_COLUMNS = {"category_code": "category_code_idx", "brand": "brand_idx", "category_id": "category_id_idx"}
USER_COLUMNS = {"age_band": "age_band_idx", "geo_province": "geo_province_idx", "device_category": "device_idx"}
ITEM_BASE = f"""
it AS (SELECT item_id, {first_of('category_id')}, {first_of('category_code')}, {first_of('brand')},
    {favg('price')} AS price, COUNT(*) AS popularity FROM al GROUP BY 1)"""
USER_BASE = f"""
us AS (SELECT user_id, {first_of('age_band')}, {first_of('geo_province')}, {first_of('device_category')},
    {first_of('customer_ltv')}, COUNT(*) AS interaction_count FROM al GROUP BY 1)"""
ALL = f"al AS (SELECT {COLUMNS} FROM ev UNION ALL SELECT {COLUMNS} FROM oev)"
WITH_ID = f"event_id, {COLUMNS}"

EVENT_SQL = {
    "unify_events": f"WITH {E} SELECT {COLUMNS} FROM ev",
    "unify_events_text": f"WITH {E} SELECT {COLUMNS.replace('event_time, event_type', '1000 * (event_time // 1000) AS event_time, event_type')} FROM ev",
    "unify_orders": f"WITH {O} SELECT {COLUMNS} FROM oev",
    "harmonize": f"WITH {E}, {O}, {ALL} SELECT * FROM al",
    "session_dwell": f"WITH {E}, {DWELL.format(src='ev')} SELECT {WITH_ID} FROM dw",
    "enrich_sessions": f"WITH {E}, {profile('ev')}, {DWELL.format(src='pf')} SELECT {WITH_ID} FROM dw",
    "implicit_ratings": f"WITH {E}, {DWELL.format(src='ev')}, {RATINGS.format(src='dw')} {RATINGS_OUT}",
    "implicit_ratings_all": f"WITH {E}, {O}, {DWELL.format(src='ev')}, al AS (SELECT {COLUMNS} FROM dw UNION ALL SELECT {COLUMNS} FROM oev), {RATINGS.format(src='al')} {RATINGS_OUT}",
    "item_features": f"WITH {E}, {O}, {ALL}, {cold('al')}, {ITEM_BASE}, "
    + encoded(ITEM_COLUMNS, "it", "it.*, it.item_id IN (SELECT item_id FROM cold) AS is_cold"),
    "item_encoders": f"WITH {E}, {O}, {ALL}, {ITEM_BASE}, lo AS ("
    + " UNION ALL ".join(f"SELECT DISTINCT '{o}' AS encoder, {c} AS value FROM it WHERE {c} IS NOT NULL" for c, o in ITEM_COLUMNS.items())
    + ") SELECT encoder, value, DENSE_RANK() OVER (PARTITION BY encoder ORDER BY value) AS idx FROM lo",
    "user_features": f"WITH {E}, {O}, {ALL}, {USER_BASE}, " + encoded(USER_COLUMNS, "us", "us.*"),
    "ordinal_encode": "SELECT p_partkey, p_name, DENSE_RANK() OVER (ORDER BY p_name) AS name_idx FROM part",
    "ordinal_encode_known": "WITH m AS (SELECT p_type, DENSE_RANK() OVER (ORDER BY p_type) AS idx FROM (SELECT DISTINCT p_type FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem))) SELECT p_partkey, part.p_type, COALESCE(idx, 0) AS type_idx FROM part LEFT JOIN m ON part.p_type = m.p_type",
    "row_copies": "SELECT l_suppkey, l_returnflag, l_linestatus, ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_returnflag, l_linestatus) AS copy_no FROM lineitem",
    "limit_rows": f"WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_orderkey || '-' || l_linenumber AS key FROM lineitem) SELECT * EXCLUDE (key) FROM k ORDER BY {unit('limit', 'key')}, key LIMIT 1000",
    "session_dwell_hot": f"WITH {E}, hot AS (SELECT * REPLACE ('s' || event_id % 3 AS user_session) FROM ev), {DWELL.format(src='hot')} SELECT {WITH_ID} FROM dw",
    "split_train": f"WITH {E}, {eligible('ev')} SELECT {WITH_ID} FROM ev WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM tu)",
    "split_test": f"WITH {E}, {eligible('ev')} SELECT {WITH_ID} FROM ev WHERE user_id IN (SELECT user_id FROM tu)",
    "null_item_attributes": f"WITH {O}, {nulled('oev')} SELECT {COLUMNS} FROM nu",
    "null_items": f"WITH {O} SELECT DISTINCT item_id FROM oev WHERE {unit('null-item', 'item_id')} < 0.25",
    "cold_items": f"WITH {O}, {cold('oev')} SELECT item_id FROM cold",
    "warm_events": f"WITH {O}, {cold('oev')} SELECT {COLUMNS} FROM oev WHERE item_id NOT IN (SELECT item_id FROM cold)",
    "cold_catalog": f"WITH {E}, {cold('ev')}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY event_time, CAST(event_id AS VARCHAR)) AS rn FROM ev WHERE item_id IN (SELECT item_id FROM cold)) SELECT {WITH_ID} FROM r WHERE rn = 1",
    "jitter_event_time": f"WITH {E}, {jittered('ev')} SELECT {WITH_ID}, true_event_time FROM ji",
    "drop_pre_purchase_carts": f"WITH {E}, day AS (SELECT * REPLACE (user_id AS user_session) FROM ev), {dropped('day', 0.5)} SELECT {WITH_ID} FROM dr",
    "append_bot_traffic": f"WITH {E}, {bots('ev', 0.05)} SELECT {WITH_ID}, CAST(NULL AS BIGINT) AS true_event_time FROM ev UNION ALL BY NAME SELECT * FROM fl",
    "degrade_all": f"WITH {E}, {nulled('ev')}, {cold('nu')}, warm AS (SELECT * FROM nu WHERE item_id NOT IN (SELECT item_id FROM cold)), {jittered('warm')}, {dropped('ji', 0.08)}, {bots('dr', 0.05)} SELECT * FROM dr UNION ALL BY NAME SELECT * FROM fl",
    "hash_sample": f"WITH {E} SELECT {WITH_ID} FROM ev WHERE {unit('sample', 'user_session')} < 0.1",
}
