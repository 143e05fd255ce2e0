"""SQL for the analytics datasets."""

from oracles.common import days, favg, fsum, local


def item(k: str, price: str) -> str:
    return (
        f"{{'item_id': CASE WHEN {k} <> 99 THEN 'I' || {k} END, 'item_name': 'Item ' || {k}, 'item_brand': 'Brand ' || ({k} % 11), "
        f"'item_category': 'Cat ' || ({k} % 7), 'item_category2': 'Cat2 ' || ({k} % 2), 'item_category3': 'Cat3 ' || ({k} % 3), "
        f"'item_category4': 'Cat4 ' || ({k} % 4), 'item_category5': CAST(NULL AS VARCHAR), 'price': {price}, 'quantity': {k} % 3 + 1}}"
    )


HAS = "event_type IN ('view', 'click', 'purchase')"
GA = f"""
ek AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
ga AS (
  SELECT 'p' || user_id AS user_pseudo_id, user_id AS uno, CASE WHEN user_id % 3 <> 0 THEN 'U' || user_id END AS user_id,
    event_id, CASE event_type WHEN 'view' THEN 'view_item' WHEN 'signup' THEN 'session_start' WHEN 'error' THEN 'page_view'
      WHEN 'click' THEN CASE k % 5 WHEN 0 THEN 'remove_from_cart' WHEN 1 THEN 'add_to_wishlist'
        WHEN 2 THEN 'begin_checkout' ELSE 'add_to_cart' END ELSE event_type END AS event_name,
    epoch_us(ts) AS event_timestamp, ts, strftime(ts, '%Y%m%d') AS event_date, CAST(ts AS DATE) AS d, value,
    list_filter([CASE WHEN {HAS} THEN {item('k', 'value')} END,
      CASE WHEN {HAS} AND (event_type = 'purchase' OR k % 4 = 0) THEN {item('((k + 1) % 100)', 'value * 0.5::DOUBLE')} END],
      lambda x: x IS NOT NULL) AS items,
    event_type = 'purchase' AS sold
  FROM ek),
gi AS (SELECT * FROM (SELECT ga.*, unnest(items) AS i FROM ga) WHERE i.item_id IS NOT NULL)"""
CD = """
cd AS (
  SELECT user_pseudo_id AS customer_id, ANY_VALUE(user_id) AS user_id, 'Continent ' || (uno % 5) AS continent,
    'Country ' || (uno % 25) AS country, 'Region ' || (uno % 40) AS region, CAST(NULL AS VARCHAR) AS metro,
    'City ' || (uno % 60) AS city, MIN('device' || (event_id % 3)) AS device_category, 'OS ' || (uno % 4) AS operating_system,
    'Browser ' || (uno % 3) AS browser, 'lang' || (uno % 6) AS language,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(uno) AS first_touch_timestamp, 'src' || (uno % 4) AS traffic_source,
    'med' || (uno % 3) AS traffic_medium, 'cmp' || (uno % 2) AS traffic_campaign,
    CASE WHEN uno % 7 <> 0 THEN 'type' || (uno % 2) END AS user_type
  FROM ga GROUP BY user_pseudo_id, uno)"""
PF = f"""
pf AS (
  SELECT i.item_id AS product_id, MIN(i.item_name) AS product_name, MIN(i.item_brand) AS brand, MIN(i.item_category) AS category,
    MIN(i.item_category2) AS category2, MIN(i.item_category3) AS category3, MIN(i.item_category4) AS category4,
    MIN(i.item_category5) AS category5, {favg('i.price')} AS avg_price, {favg('i.quantity', 0)} AS avg_quantity,
    COUNT(DISTINCT user_pseudo_id) AS unique_users_viewed, COUNT(DISTINCT event_date) AS days_available,
    CAST(SUM(i.quantity) AS BIGINT) AS total_quantity_sold, {fsum('i.price * i.quantity')} AS total_revenue
  FROM gi GROUP BY 1)"""


def distinct_when(tests: dict[str, str], stamp: str) -> str:
    return ", ".join(f"COUNT(DISTINCT CASE WHEN {t} THEN {stamp} END) AS {n}" for n, t in tests.items())


PAIR = distinct_when(
    {
        "view_count": "event_name = 'view_item'", "cart_add_count": "event_name = 'add_to_cart'",
        "cart_remove_count": "event_name = 'remove_from_cart'", "wishlist_count": "event_name = 'add_to_wishlist'",
        "checkout_start_count": "event_name = 'begin_checkout'", "purchase_count": "event_name = 'purchase'",
    },
    "event_timestamp",
)
CPI = f"""
cpi AS (
  SELECT user_pseudo_id AS customer_id, i.item_id AS product_id, {PAIR},
    {favg('CASE WHEN sold THEN i.price END')} AS avg_purchase_price,
    {fsum('CASE WHEN sold THEN i.price * i.quantity ELSE 0 END')} AS total_spent,
    MAX(CASE WHEN sold THEN i.quantity END) AS max_quantity_purchased,
    MIN(event_timestamp) AS first_interaction_timestamp, MAX(event_timestamp) AS last_interaction_timestamp,
    {days('MAX(d)', 'MIN(ts)')} AS days_since_first_interaction
  FROM gi GROUP BY 1, 2)"""
ET = f"""
SELECT user_pseudo_id AS customer_id, event_name AS event_type, 'T' || event_id AS transaction_id,
  value * 2.0::DOUBLE AS transaction_value, 'USD' AS currency, value * 0.125::DOUBLE AS tax_amount, 5.0::DOUBLE AS shipping_amount,
  {fsum('i.price * i.quantity')} AS items_total_value, CAST(SUM(i.quantity) AS BIGINT) AS total_items_purchased,
  event_timestamp AS transaction_timestamp, event_date AS transaction_date
FROM (SELECT ga.*, unnest(items) AS i FROM ga) WHERE sold GROUP BY ALL"""
CBN = distinct_when(
    {
        "session_count": "event_name = 'session_start'", "page_view_count": "event_name = 'page_view'",
        "item_view_count": "event_name = 'view_item'", "cart_add_count": "event_name = 'add_to_cart'",
        "purchase_count": "event_name = 'purchase'",
    },
    "event_timestamp",
)
CB = f"""
cb AS (
  SELECT user_pseudo_id AS customer_id, {CBN},
    {fsum('CASE WHEN sold THEN value * 2.0::DOUBLE ELSE 0 END')} AS total_revenue,
    {favg('CASE WHEN sold THEN value * 2.0::DOUBLE END')} AS avg_transaction_value,
    MIN(event_timestamp) AS first_event_timestamp, MAX(event_timestamp) AS last_event_timestamp,
    {days('MAX(d)', 'MIN(ts)')} AS customer_lifetime_days
  FROM ga GROUP BY 1)"""


def closeness(paid: str, listed: str) -> str:
    return f"CASE WHEN {listed} > 0 THEN ROUND(1 - ABS(COALESCE({paid}, 0) - {listed}) / {listed}, 2) ELSE 0 END"


GA_MAIN = f"""
SELECT cpi.customer_id, cpi.product_id, product_name, brand, category AS product_category, user_id, continent, country,
  region, city, device_category, operating_system, browser, language, traffic_source, traffic_medium, traffic_campaign,
  user_type, cpi.view_count AS product_views, cpi.cart_add_count AS product_cart_adds, wishlist_count AS product_wishlist_adds,
  cpi.purchase_count AS product_purchases, COALESCE(total_spent, 0) AS total_spent_on_product,
  COALESCE(avg_purchase_price, 0) AS avg_purchase_price, COALESCE(max_quantity_purchased, 0) AS max_quantity_purchased,
  avg_price AS product_avg_price, total_quantity_sold AS product_total_sold, pf.total_revenue AS product_total_revenue,
  unique_users_viewed AS product_unique_viewers, avg_price AS product_list_price,
  COALESCE(avg_purchase_price, 0) - avg_price AS price_difference, cb.total_revenue AS customer_lifetime_value,
  COALESCE(avg_transaction_value, 0) AS avg_transaction_value, session_count AS total_sessions,
  page_view_count AS total_page_views, item_view_count AS total_item_views, cb.cart_add_count AS total_cart_adds,
  cb.purchase_count AS total_purchases, {local('make_timestamp(last_interaction_timestamp)', 'last_interaction')},
  days_since_first_interaction, customer_lifetime_days, CASE WHEN cpi.purchase_count > 0 THEN 1 ELSE 0 END AS has_purchased,
  CASE WHEN cpi.cart_add_count > 0 THEN 1 ELSE 0 END AS has_added_to_cart,
  CASE WHEN cpi.view_count > 0 THEN 1 ELSE 0 END AS has_viewed,
  cpi.view_count * 0.1::DOUBLE + cpi.cart_add_count * 0.3::DOUBLE + cpi.purchase_count * 0.6::DOUBLE + total_spent / 10 AS engagement_score,
  {closeness('avg_purchase_price', 'avg_price')} AS price_sensitivity_index
FROM cpi LEFT JOIN cd USING (customer_id) LEFT JOIN pf ON cpi.product_id = pf.product_id LEFT JOIN cb USING (customer_id)"""


def product(k: str, price: str) -> str:
    return (
        f"{{'sku': 'S' || {k}, 'name': 'Product ' || {k}, 'cat': 'Category ' || ({k} % 9), 'brand': 'Brand ' || ({k} % 11), "
        f"'price': {price}, 'qty': {k} % 3 + 1, 'rev': CASE WHEN event_type = 'purchase' THEN {price} * ({k} % 3 + 1) END}}"
    )


ONE, TWO = product("k", "m"), product("((k + 1) % 100)", "m // 2")
UA = f"""
ek AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(round_even(value * 1e6, 0) AS BIGINT) AS m FROM events),
us AS (
  SELECT 'v' || user_id AS customer_id, user_id AS uno, event_id AS visit, date_trunc('second', ts) AS visit_ts,
    CAST(ts AS DATE) AS d, strftime(ts, '%Y%m%d') AS day, event_id, event_type, k, m,
    CASE WHEN event_type IN ('view', 'purchase') THEN '/product/' || k ELSE '/home' END AS path,
    CASE event_type WHEN 'view' THEN '2' WHEN 'click' THEN '3' WHEN 'error' THEN '4' WHEN 'signup' THEN '5' ELSE '6' END AS act
  FROM ek),
hp AS (
  SELECT us.*, 'PAGE' AS type, 1 + event_id % 50 AS hit, '0' AS action, {ONE} AS p FROM us
  UNION ALL SELECT us.*, 'EVENT', 100 + event_id % 50, act, {ONE} FROM us
  UNION ALL SELECT us.*, 'EVENT', 100 + event_id % 50, act, {TWO} FROM us WHERE k % 4 = 0)"""
UCD = """
cd AS (
  SELECT customer_id, 'Continent ' || (uno % 5) AS continent, 'Country ' || (uno % 25) AS country,
    'Region ' || (uno % 40) AS region, CAST(NULL AS VARCHAR) AS metro, 'City ' || (uno % 60) AS city,
    'net' || (uno % 8) AS network_domain, MIN('device' || (event_id % 3)) AS device_category,
    'OS ' || (uno % 4) AS operating_system, 'mb' || (uno % 3) AS mobile_brand, 'mm' || (uno % 5) AS mobile_model,
    'mi' || (uno % 2) AS mobile_input, CAST(NULL AS VARCHAR) AS mobile_marketing_name, 'src' || (uno % 4) AS traffic_source,
    'med' || (uno % 3) AS traffic_medium, 'cmp' || (uno % 2) AS traffic_campaign, 'kw' || (uno % 9) AS traffic_keyword,
    '/ref/' || (uno % 6) AS referral_path, MIN(visit_ts) AS first_visit_timestamp
  FROM us GROUP BY customer_id, uno)"""
UPF = f"""
pf AS (
  SELECT p.sku AS product_id, MIN(p.name) AS product_name, MIN(p.cat) AS product_category, MIN(p.brand) AS product_brand,
    CAST(NULL AS VARCHAR) AS product_variant, {favg('p.price', 0)} AS avg_product_price, {favg('p.qty', 0)} AS avg_quantity,
    {favg('p.rev', 0)} AS avg_product_revenue, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(DISTINCT customer_id || '_' || visit) AS unique_sessions, CAST(SUM(p.qty) AS BIGINT) AS total_quantity_viewed,
    {fsum('p.rev', 0)} / 1000000.0::DOUBLE AS total_revenue
  FROM hp WHERE type = 'PAGE' GROUP BY 1)"""
UN = distinct_when(
    {
        "product_page_views": "type = 'PAGE' AND path LIKE '%product%'", "product_clicks": "action = '2'",
        "add_to_cart_count": "action = '3'", "remove_from_cart_count": "action = '4'",
        "checkout_start_count": "action = '5'", "purchase_count": "action = '6'",
    },
    "hit",
)
UCPI = f"""
cpi AS (
  SELECT customer_id, p.sku AS product_id, {UN}, {favg('p.price', 0)} AS avg_view_price,
    {fsum("CASE WHEN action = '6' THEN p.price * p.qty ELSE 0 END", 0)} AS total_purchased_value,
    MAX(p.qty) AS max_quantity_purchased, MIN(visit_ts) AS first_interaction_timestamp,
    MAX(visit_ts) AS last_interaction_timestamp, COUNT(DISTINCT visit) AS session_count
  FROM hp GROUP BY 1, 2)"""
UTD = f"""
SELECT customer_id, 'T' || event_id AS transaction_id, m * 2 / 1000000.0::DOUBLE AS transaction_value, 'USD' AS currency,
  (m // 10) / 1000000.0::DOUBLE AS tax_amount, 5.0::DOUBLE AS shipping_amount,
  {fsum('m * 2', 0)} / 1000000.0::DOUBLE AS total_transaction_value,
  CAST(SUM(k % 3 + 1 + CASE WHEN k % 4 = 0 THEN (k + 1) % 100 % 3 + 1 ELSE 0 END) AS BIGINT) AS total_items_purchased,
  visit_ts AS transaction_timestamp, day AS transaction_date
FROM us WHERE event_type = 'purchase' GROUP BY ALL"""
UCB = f"""
cb AS (
  SELECT customer_id, COUNT(DISTINCT visit) AS session_count, COUNT(*) AS total_visits,
    CAST(SUM(k % 3 + 1) AS BIGINT) AS total_pageviews,
    CAST(SUM(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS total_bounces,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS total_transactions,
    {fsum("CASE WHEN event_type = 'purchase' THEN m * 2 END", 0)} / 1000000.0::DOUBLE AS total_revenue,
    {favg("CASE WHEN event_type = 'purchase' THEN m * 2 END", 0)} / 1000000.0::DOUBLE AS avg_transaction_value,
    MIN(visit_ts) AS first_visit_timestamp, MAX(visit_ts) AS last_visit_timestamp,
    {days('MAX(d)', 'MIN(visit_ts)')} AS customer_lifetime_days
  FROM us GROUP BY 1)"""
UA_MAIN = f"""
SELECT cpi.customer_id, cpi.product_id, product_name, product_category, product_brand, product_variant, device_category,
  operating_system, mobile_brand, country, region, city, traffic_source, traffic_medium, traffic_campaign,
  product_page_views, product_clicks, add_to_cart_count, purchase_count, total_purchased_value, avg_view_price,
  max_quantity_purchased, COALESCE(avg_product_price, 0) AS product_avg_price,
  COALESCE(total_quantity_viewed, 0) AS product_total_viewed, COALESCE(pf.total_revenue, 0) AS product_total_revenue,
  COALESCE(unique_customers, 0) AS product_unique_customers, avg_product_price AS product_list_price,
  avg_view_price - COALESCE(avg_product_price, 0) AS price_difference,
  COALESCE(cb.total_revenue, 0) AS customer_lifetime_value, COALESCE(avg_transaction_value, 0) AS avg_transaction_value,
  cb.session_count AS total_sessions, total_visits, total_pageviews, COALESCE(total_transactions, 0) AS total_transactions,
  {local('last_interaction_timestamp', 'last_interaction')}, cpi.session_count AS customer_product_sessions,
  customer_lifetime_days, CASE WHEN purchase_count > 0 THEN 1 ELSE 0 END AS has_purchased,
  CASE WHEN add_to_cart_count > 0 THEN 1 ELSE 0 END AS has_added_to_cart,
  CASE WHEN product_page_views > 0 THEN 1 ELSE 0 END AS has_viewed_product,
  product_page_views * 0.1::DOUBLE + add_to_cart_count * 0.3::DOUBLE + purchase_count * 0.6::DOUBLE + total_purchased_value / 10 AS engagement_score,
  {closeness('avg_view_price', 'avg_product_price')} AS price_sensitivity_index,
  CASE WHEN product_page_views > 0 THEN purchase_count * 100.0::DOUBLE / product_page_views ELSE 0 END AS conversion_rate_percentage
FROM cpi LEFT JOIN cd USING (customer_id) LEFT JOIN pf ON cpi.product_id = pf.product_id LEFT JOIN cb USING (customer_id)"""
ANALYTICS_SQL = {
    "ga_customer_demographics": f"WITH {GA}, {CD} SELECT * FROM cd",
    "ga_product_features": f"WITH {GA}, {PF} SELECT * FROM pf",
    "ga_interactions": f"WITH {GA}, {CPI} SELECT * FROM cpi",
    "ga_transactions": f"WITH {GA} {ET}",
    "ga_customer_behavior": f"WITH {GA}, {CB} SELECT * FROM cb",
    "ga_main": f"WITH {GA}, {CD}, {PF}, {CPI}, {CB} {GA_MAIN}",
    "ua_customer_demographics": f"WITH {UA}, {UCD} SELECT * FROM cd",
    "ua_product_features": f"WITH {UA}, {UPF} SELECT * FROM pf",
    "ua_interactions": f"WITH {UA}, {UCPI} SELECT * FROM cpi",
    "ua_transactions": f"WITH {UA} {UTD}",
    "ua_customer_behavior": f"WITH {UA}, {UCB} SELECT * FROM cb",
    "ua_main": f"WITH {UA}, {UCD}, {UPF}, {UCPI}, {UCB} {UA_MAIN}",
}
