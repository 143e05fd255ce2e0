"""SQL for the retail dataset."""

from oracles.common import days, favg, fsum, local, snap

AS_OF = "DATE '2002-01-01'"
SALES = """
sales AS (
  SELECT s_suppkey AS store_number,
    CASE s_suppkey % 6 WHEN 0 THEN 'HY-VEE #' || s_suppkey WHEN 1 THEN 'FAREWAY STORES ' || s_suppkey
      WHEN 2 THEN 'WALMART #' || s_suppkey WHEN 3 THEN 'QUICK STOP ' || s_suppkey
      WHEN 4 THEN 'CONVENIENCE ' || s_suppkey ELSE s_name END AS store_name,
    s_suppkey || ' MAIN ST, ' || n_name AS address, n_name AS city,
    lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS zip_code, 'County ' || n_regionkey AS county,
    CAST(n_regionkey AS BIGINT) AS county_number, p_partkey AS item_number, p_name AS item_description,
    CAST(p_size % 10 AS VARCHAR) AS category, p_type AS category_name, p_brand AS vendor_number,
    'Vendor ' || p_brand AS vendor_name, CAST(p_size AS BIGINT) AS pack,
    CAST(p_size * 50 AS BIGINT) AS bottle_volume_ml, p_retailprice * 0.5::DOUBLE AS state_bottle_cost,
    p_retailprice + l_discount * 10.0::DOUBLE AS state_bottle_retail, l_extendedprice AS sale_dollars,
    CAST(l_quantity AS BIGINT) AS bottles_sold, l_quantity * 0.75::DOUBLE AS volume_sold_liters,
    l_quantity * 0.2::DOUBLE AS volume_sold_gallons, CAST(l_shipdate AS DATE) AS date
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey)"""
STORES = """
sd AS (
  SELECT DISTINCT store_number AS customer_id, store_name AS customer_name, address, city, zip_code, county,
    county_number, split_part(address, ',', 1) AS street_address,
    CASE WHEN store_name LIKE '%HY-VEE%' THEN 'Supermarket Chain' WHEN store_name LIKE '%FAREWAY%' THEN 'Regional Grocery'
      WHEN store_name LIKE '%WALMART%' THEN 'Big Box Retail'
      WHEN store_name LIKE '%QUICK%' OR store_name LIKE '%CONVENIENCE%' THEN 'Convenience Store'
      ELSE 'Other Retail' END AS store_type,
    CASE WHEN store_name LIKE '%#%' THEN 'Chain Store' ELSE 'Independent Store' END AS store_size_category
  FROM sales)"""
PRODUCTS = f"""
pf0 AS (
  SELECT item_number AS product_id, MIN(item_description) AS product_name, MIN(category) AS category,
    MIN(category_name) AS category_name, MIN(vendor_number) AS vendor_number, MIN(vendor_name) AS vendor_name,
    MIN(pack) AS pack, MIN(bottle_volume_ml) AS bottle_volume_ml, {favg('state_bottle_cost')} AS avg_cost,
    {favg('state_bottle_retail')} AS avg_retail_price, {favg('sale_dollars')} AS avg_sale_dollars,
    {favg('volume_sold_liters')} AS avg_volume_liters, {favg('volume_sold_gallons')} AS avg_volume_gallons,
    COUNT(DISTINCT store_number) AS stores_selling, COUNT(DISTINCT date) AS days_available,
    CAST(SUM(bottles_sold) AS BIGINT) AS total_bottles_sold, {fsum('sale_dollars')} AS total_revenue,
    ROUND({favg('sale_dollars / NULLIF(volume_sold_liters, 0)')}, 2) AS avg_price_per_liter
  FROM sales GROUP BY 1),
pf AS (SELECT *, COUNT(*) OVER (PARTITION BY category_name) AS category_popularity FROM pf0)"""
PAIRS = f"""
spi AS (
  SELECT store_number AS customer_id, item_number AS product_id, category_name, vendor_name, COUNT(DISTINCT date) AS purchase_frequency,
    CAST(SUM(bottles_sold) AS BIGINT) AS total_bottles_purchased, {fsum('sale_dollars')} AS total_spent,
    {favg('state_bottle_retail')} AS avg_price_per_bottle, {favg('volume_sold_liters')} AS avg_volume_per_transaction,
    MAX(date) AS last_purchase_date, MIN(date) AS first_purchase_date,
    {days('MAX(date)', 'MIN(date)')} AS customer_relationship_days,
    COUNT(DISTINCT MONTH(date)) AS months_purchased, COUNT(DISTINCT DAYOFWEEK(date)) AS days_of_week_purchased,
    STDDEV_SAMP(state_bottle_retail) AS price_variation, {favg('pack')} AS avg_pack_size,
    STDDEV_SAMP(bottles_sold) AS purchase_quantity_variation
  FROM sales GROUP BY 1, 2, 3, 4)"""
TOP = f"""
cs AS (SELECT store_number AS customer_id, category_name, {fsum('sale_dollars')} AS spent FROM sales GROUP BY 1, 2),
cr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY spent DESC, category_name) AS r FROM cs),
tc AS (SELECT customer_id, STRING_AGG(category_name, ', ' ORDER BY r) AS top_categories FROM cr WHERE r <= 3 GROUP BY 1)"""
BEHAVIOR = f"""
sb0 AS (
  SELECT store_number AS customer_id, COUNT(DISTINCT item_number) AS unique_products_purchased,
    COUNT(DISTINCT category_name) AS unique_categories_purchased, COUNT(DISTINCT vendor_name) AS unique_vendors_purchased,
    {fsum('sale_dollars')} AS total_spent_all_time, {favg('sale_dollars')} AS avg_transaction_value,
    CAST(SUM(bottles_sold) AS BIGINT) AS total_bottles_all_time, COUNT(DISTINCT date) AS active_days,
    {days('MAX(date)', 'MIN(date)')} AS days_active, COUNT(DISTINCT MONTH(date)) AS active_months,
    {days(AS_OF, 'MAX(date)')} AS days_since_last_purchase
  FROM sales GROUP BY 1),
sb AS (SELECT * FROM sb0 JOIN tc USING (customer_id))"""
RETAIL_SQL = {
    "retail_store_demographics": f"WITH {SALES}, {STORES} SELECT * FROM sd",
    "retail_product_features": f"WITH {SALES}, {PRODUCTS} SELECT * FROM pf",
    "retail_interactions": f"WITH {SALES}, {PAIRS} SELECT * REPLACE (ROUND(price_variation, 4) AS price_variation, ROUND(purchase_quantity_variation, 4) AS purchase_quantity_variation) FROM spi",
    "retail_store_behavior": f"WITH {SALES}, {TOP}, {BEHAVIOR} SELECT * FROM sb",
    "top_categories": f"WITH {SALES}, {TOP} SELECT * FROM tc",
    "retail_main": f"""WITH {SALES}, {STORES}, {PRODUCTS}, {PAIRS}, {TOP}, {BEHAVIOR}
SELECT customer_id, product_id, product_name, category, pf.category_name, pf.vendor_name,
  spi.vendor_name AS vendor_from_interaction, customer_name AS store_name, city AS store_city, zip_code AS store_zip_code,
  county AS store_county, store_type, store_size_category, purchase_frequency, total_bottles_purchased, total_spent,
  avg_price_per_bottle, avg_volume_per_transaction, avg_pack_size,
  ROUND(purchase_quantity_variation, 4) AS purchase_quantity_variation, avg_cost AS product_avg_cost,
  avg_retail_price AS product_avg_retail_price, avg_price_per_liter, avg_price_per_bottle AS store_avg_price_per_bottle,
  ROUND(avg_price_per_bottle - avg_retail_price, 2) AS price_difference_from_avg, stores_selling AS product_availability,
  total_bottles_sold AS product_total_sales_volume, total_revenue AS product_total_revenue, category_popularity,
  {local('last_purchase_date', 'last_purchase', 'last_purchase_utc9')},
  CAST(first_purchase_date AS TIMESTAMP) + INTERVAL 9 HOUR AS first_purchase_utc9,
  unique_products_purchased AS store_unique_products, unique_categories_purchased AS store_unique_categories,
  total_spent_all_time AS store_lifetime_value, avg_transaction_value, active_days, days_active AS store_days_active,
  days_since_last_purchase AS store_recency, CASE WHEN total_bottles_purchased > 0 THEN 1 ELSE 0 END AS has_purchased,
  {days(AS_OF, 'last_purchase_date')} AS days_since_last_purchase,
  ROUND(CASE WHEN total_spent_all_time > 0 THEN total_spent / total_spent_all_time * 100 ELSE 0 END, 2)
    AS product_share_of_store_spending,
  CASE WHEN price_variation > 0 AND purchase_frequency > 1
    THEN {snap('purchase_quantity_variation / price_variation', 2)} ELSE 0 END AS price_elasticity_proxy
FROM spi JOIN pf USING (product_id) JOIN sd USING (customer_id) JOIN sb USING (customer_id)
WHERE total_bottles_purchased > 0""",
}
RETAIL_SQL["retail_main_ordered"] = f"""SELECT ROW_NUMBER() OVER (ORDER BY customer_id NULLS FIRST, product_id NULLS FIRST) AS position,
  customer_id, product_id FROM ({RETAIL_SQL['retail_main']})"""
