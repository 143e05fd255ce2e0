"""Shapes of the raw sources, derived row by row from the TPC-H-like tables and ``events``.

The check tables do not contain shop, retail or analytics exports. These projections (and a
few key joins) give them the column layout the operators expect. Nothing is grouped here, so
a hot key stays as spread out as it is in the source table; nested arrays are built inside a
row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep.session import materialize
from recprep.sources.events import harmonize_behavior, harmonize_orders

EVENT_TYPES = {"view": "view", "click": "cart", "purchase": "purchase", "signup": "remove_from_cart"}
REGION_PROVINCES = {
    "NATION_0": "ID-JK", "NATION_1": "ID-JB", "NATION_2": "ID-JT", "NATION_3": "ID-JI",
    "NATION_4": "ID-PA", "NATION_5": "ID-SN", "NATION_6": "ID-SU", "NATION_7": "ID-KI",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item_no():
    return F.get_json_object("props", "$.k").cast("long")


def _picked(column: str, values: dict[str, str]):
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.col(column))


# --- unified events -------------------------------------------------------------------


def raw_behavior(spark: SparkSession, sf_dir: str, text_time: bool = False) -> DataFrame:
    """``events`` as a behavior log, one session per user and day; ``event_id`` is kept."""
    e = table(spark, sf_dir, "events").withColumn("k", _item_no())
    time = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")) if text_time else F.col("ts")
    return e.select(
        "event_id",
        time.alias("event_time"),
        _picked("event_type", EVENT_TYPES).alias("event_type"),
        F.concat(F.lit("p"), F.col("k")).alias("product_id"),
        F.concat(F.lit("c"), F.col("k") % 7).alias("category_id"),
        F.concat(F.lit("cat."), F.col("k") % 13).alias("category_code"),
        F.when(F.col("k") % 10 != 0, F.concat(F.lit("b"), F.col("k") % 11)).alias("brand"),
        F.col("value").alias("price"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
        F.concat(F.lit("u"), F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("user_session"),
    )


def behavior_events(spark: SparkSession, sf_dir: str, text_time: bool = False) -> DataFrame:
    return harmonize_behavior(raw_behavior(spark, sf_dir, text_time))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified behavior events plus their ``event_id``, for row-keyed operators."""
    return harmonize_behavior(raw_behavior(spark, sf_dir), keep=("event_id",))


def raw_orders(spark: SparkSession, sf_dir: str, key: str | None = None) -> DataFrame:
    """``lineitem`` with its order, part and customer as an order table; ``key`` names a row id to add."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    joined = (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
    )
    age = F.when(F.col("c_custkey") % 10 != 0, F.lit(18) + F.col("c_custkey") % 60)
    return joined.select(
        F.concat(F.lit("u"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("product_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_extendedprice").alias("price"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("region"),
        age.cast("int").alias("age"),
        (F.col("l_discount") > 0.05).alias("discount"),
        F.col("c_acctbal").alias("ltv"),
        *([] if key is None else [F.concat_ws("-", F.concat(F.lit("o"), F.col("l_orderkey")), "l_linenumber").alias(key)]),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize_orders(raw_orders(spark, sf_dir), REGION_PROVINCES)


# --- retail sales ---------------------------------------------------------------------


def retail_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as sales of parts by suppliers (stores)."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    store = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    joined = line.join(part, line.l_partkey == part.p_partkey).join(store, line.l_suppkey == store.s_suppkey)
    number = F.col("s_suppkey").cast("string")
    kind = F.col("s_suppkey") % 6
    name = (
        F.when(kind == 0, F.concat(F.lit("HY-VEE #"), number))
        .when(kind == 1, F.concat(F.lit("FAREWAY STORES "), number))
        .when(kind == 2, F.concat(F.lit("WALMART #"), number))
        .when(kind == 3, F.concat(F.lit("QUICK STOP "), number))
        .when(kind == 4, F.concat(F.lit("CONVENIENCE "), number))
        .otherwise(F.col("s_name"))
    )
    return joined.select(
        F.col("s_suppkey").alias("store_number"),
        name.alias("store_name"),
        F.concat(number, F.lit(" MAIN ST, "), F.col("n_name")).alias("address"),
        F.col("n_name").alias("city"),
        F.lpad(number, 5, "0").alias("zip_code"),
        F.concat(F.lit("County "), F.col("n_regionkey")).alias("county"),
        F.col("n_regionkey").cast("long").alias("county_number"),
        F.col("p_partkey").alias("item_number"),
        F.col("p_name").alias("item_description"),
        (F.col("p_size") % 10).cast("string").alias("category"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("vendor_number"),
        F.concat(F.lit("Vendor "), F.col("p_brand")).alias("vendor_name"),
        F.col("p_size").cast("long").alias("pack"),
        (F.col("p_size") * 50).cast("long").alias("bottle_volume_ml"),
        (F.col("p_retailprice") * 0.5).alias("state_bottle_cost"),
        (F.col("p_retailprice") + F.col("l_discount") * 10.0).alias("state_bottle_retail"),
        F.col("l_extendedprice").alias("sale_dollars"),
        F.col("l_quantity").cast("long").alias("bottles_sold"),
        (F.col("l_quantity") * 0.75).alias("volume_sold_liters"),
        (F.col("l_quantity") * 0.2).alias("volume_sold_gallons"),
        F.to_date("l_shipdate").alias("date"),
    )


# --- web shop -------------------------------------------------------------------------

SHOP_KINDS = {"view": "product", "click": "cart", "signup": "department", "error": "home"}
DEPARTMENTS = ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL")


def shop_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key.alias("id"),
        F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.lit(18) + key % 60).alias("age"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), key % 50).alias("city"),
        F.concat(F.lit("State "), key % 20).alias("state"),
        F.col("c_mktsegment").alias("traffic_source"),
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", _item_no()).withColumn(
        "kind", _picked("event_type", SHOP_KINDS)
    )
    department = F.element_at(F.array(*[F.lit(d) for d in DEPARTMENTS]), (F.col("k") % len(DEPARTMENTS)).cast("int") + 1)
    uri = (
        F.when(F.col("kind") == "product", F.concat(F.lit("/product/"), F.col("k")))
        .when(F.col("kind") == "cart", F.concat(F.lit("/product/"), F.col("k"), F.lit("/cart")))
        .when(F.col("kind") == "department", F.concat(F.lit("/department/"), department, F.lit("/category")))
        .otherwise(F.concat(F.lit("/"), F.col("kind")))
    )
    return e.select(
        F.col("event_id").alias("id"), "user_id", F.col("kind").alias("event_type"),
        F.col("ts").alias("created_at"), uri.alias("uri"),
    )


def _line_id():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def shop_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("l_returnflag") == "R", F.lit("Returned"))
        .when(F.col("l_discount") == 0.0, F.lit("Cancelled"))
        .otherwise(F.lit("Complete"))
    )
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        _line_id().alias("id"), F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"), status.alias("status"), F.col("l_extendedprice").alias("sale_price"),
    )


def shop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), (F.col("p_retailprice") * 50.0).alias("retail_price"),
    )


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 4 + 1).alias("num_of_item"),
    )


def shop_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("distribution_center_id"), (F.col("l_extendedprice") * 0.5).alias("cost"),
        (F.col("l_shipdate") - F.expr("INTERVAL '10' DAY")).alias("created_at"), F.col("l_shipdate").alias("sold_at"),
    )


def shop_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        (F.col("s_nationkey") * 1.5).alias("latitude"), F.col("s_acctbal").alias("longitude"),
    )


# --- ledger ---------------------------------------------------------------------------


def ledger_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transaction per ``lineitem`` row; its inputs and outputs are built inside the row."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey).withColumn(
        "cents", F.rint(F.col("l_extendedprice") * 100).cast("long")
    )

    def party(address, value):
        return F.struct(address.alias("address"), value.cast("long").alias("value"))

    supplier = F.concat(F.lit("3S"), F.col("l_suppkey"))
    payer = F.when(F.col("o_custkey") % 50 != 0, F.concat(F.lit("1C"), F.col("o_custkey")))
    net = F.expr("cents * (100 - CAST(rint(l_discount * 100) AS BIGINT)) div 100")
    inputs = F.array_compact(F.array(
        party(payer, F.col("cents")),
        F.when(F.col("l_linenumber") % 2 == 0, party(supplier, F.col("l_quantity") * 1000)),
    ))
    outputs = F.array_compact(F.array(
        party(F.concat(F.lit("1P"), F.col("l_partkey")), net),
        F.when(F.col("l_tax") > 0, party(supplier, F.expr("cents div 20"))),
        F.when(
            F.col("l_linenumber") == 7,
            party(F.concat(F.lit("bc1q"), F.lpad(F.col("l_partkey").cast("string"), 36, "0")), F.col("cents") % 1000),
        ),
    ))
    return joined.select(
        F.concat(F.lit("tx"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("hash"),
        F.col("l_orderkey").alias("block_number"),
        F.col("l_shipdate").alias("block_timestamp"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)).alias("is_coinbase"),
        F.size(inputs).alias("input_count"),
        F.size(outputs).alias("output_count"),
        F.rint(F.col("l_tax") * 1000).cast("long").alias("fee"),
        F.col("cents").alias("input_value"),
        net.cast("long").alias("output_value"),
        inputs.alias("inputs"),
        outputs.alias("outputs"),
    )


# --- analytics exports ----------------------------------------------------------------


def _numbered(word: str, modulus: int):
    return F.concat(F.lit(word), F.col("user_id") % modulus)


def ga4_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an event-level export: one row per event, its items inside the row."""
    e = table(spark, sf_dir, "events").withColumn("k", _item_no())
    cart = (
        F.when(F.col("k") % 5 == 0, F.lit("remove_from_cart"))
        .when(F.col("k") % 5 == 1, F.lit("add_to_wishlist"))
        .when(F.col("k") % 5 == 2, F.lit("begin_checkout"))
        .otherwise(F.lit("add_to_cart"))
    )
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", F.lit("view_item")).when(kind == "click", cart)
        .when(kind == "signup", F.lit("session_start")).when(kind == "error", F.lit("page_view")).otherwise(kind)
    )

    def item(k, price):
        return F.struct(
            F.when(k != 99, F.concat(F.lit("I"), k)).alias("item_id"),
            F.concat(F.lit("Item "), k).alias("item_name"),
            F.concat(F.lit("Brand "), k % 11).alias("item_brand"),
            F.concat(F.lit("Cat "), k % 7).alias("item_category"),
            *[F.concat(F.lit(f"Cat{i} "), k % i).alias(f"item_category{i}") for i in range(2, 5)],
            F.lit(None).cast("string").alias("item_category5"),
            price.alias("price"),
            (k % 3 + 1).alias("quantity"),
        )

    k, value = F.col("k"), F.col("value")
    has_items = kind.isin("view", "click", "purchase")
    items = F.array_compact(F.array(
        F.when(has_items, item(k, value)),
        F.when(has_items & ((kind == "purchase") | (k % 4 == 0)), item((k + 1) % 100, value * 0.5)),
    ))
    sale = F.struct(
        F.concat(F.lit("T"), F.col("event_id")).alias("transaction_id"), (value * 2.0).alias("value"),
        F.lit("USD").alias("currency"), (value * 0.125).alias("tax"), F.lit(5.0).alias("shipping"),
    )
    user = F.col("user_id")

    def prop(key, text):
        return F.struct(F.lit(key).alias("key"), F.struct(text.alias("string_value")).alias("value"))

    day = F.date_format("ts", "yyyyMMdd")
    return e.select(
        F.concat(F.lit("p"), user).alias("user_pseudo_id"),
        F.when(user % 3 != 0, F.concat(F.lit("U"), user)).alias("user_id"),
        name.alias("event_name"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        day.alias("event_date"),
        day.alias("table_suffix"),
        (F.lit(1_704_067_200_000_000) + user * 1_000_000).alias("user_first_touch_timestamp"),
        F.struct(
            _numbered("Continent ", 5).alias("continent"), _numbered("Country ", 25).alias("country"),
            _numbered("Region ", 40).alias("region"), F.lit(None).cast("string").alias("metro"),
            _numbered("City ", 60).alias("city"),
        ).alias("geo"),
        F.struct(
            F.concat(F.lit("device"), F.col("event_id") % 3).alias("category"), _numbered("OS ", 4).alias("operating_system"),
            _numbered("lang", 6).alias("language"), F.struct(_numbered("Browser ", 3).alias("browser")).alias("web_info"),
        ).alias("device"),
        F.struct(
            _numbered("src", 4).alias("source"), _numbered("med", 3).alias("medium"), _numbered("cmp", 2).alias("campaign"),
        ).alias("traffic_source"),
        F.array_compact(F.array(
            prop("tier", _numbered("t", 3)), F.when(user % 7 != 0, prop("user_type", _numbered("type", 2))),
        )).alias("user_properties"),
        items.alias("items"),
        F.when(kind == "purchase", sale).alias("ecommerce"),
    )


def ua_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a session-level export: a visit per event with a page and an action hit."""
    e = table(spark, sf_dir, "events").withColumn("k", _item_no()).withColumn(
        "micros", F.rint(F.col("value") * 1e6).cast("long")
    )
    kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id")
    sold = kind == "purchase"

    def product(number, price):
        quantity = (number % 3 + 1).cast("long")
        return F.struct(
            F.concat(F.lit("S"), number).alias("productSKU"), F.concat(F.lit("Product "), number).alias("v2ProductName"),
            F.concat(F.lit("Category "), number % 9).alias("v2ProductCategory"),
            F.concat(F.lit("Brand "), number % 11).alias("productBrand"),
            F.lit(None).cast("string").alias("productVariant"),
            price.alias("productPrice"), quantity.alias("productQuantity"),
            F.when(sold, price * quantity).alias("productRevenue"),
        )

    action = (
        F.when(kind == "view", F.lit("2")).when(kind == "click", F.lit("3")).when(kind == "error", F.lit("4"))
        .when(kind == "signup", F.lit("5")).otherwise(F.lit("6"))
    )
    sale = F.when(sold, F.struct(
        F.concat(F.lit("T"), F.col("event_id")).alias("transactionId"), (F.col("micros") * 2).alias("transactionRevenue"),
        F.lit("USD").alias("transactionCurrency"), F.expr("micros div 10").alias("transactionTax"),
        F.lit(5_000_000).cast("long").alias("transactionShipping"),
    ))

    def hit(kind_, number, path, code, products, transaction):
        return F.struct(
            F.lit(kind_).alias("type"), number.alias("hitNumber"), F.struct(path.alias("pagePath")).alias("page"),
            F.struct(code.alias("action_type")).alias("eCommerceAction"), products.alias("product"),
            transaction.alias("transaction"),
        )

    path = F.when(kind.isin("view", "purchase"), F.concat(F.lit("/product/"), k)).otherwise(F.lit("/home"))
    one = product(k, F.col("micros"))
    two = F.when(k % 4 == 0, product((k + 1) % 100, F.expr("micros div 2")))
    nothing = F.when(F.lit(False), sale)
    hits = F.array(
        hit("PAGE", F.lit(1) + F.col("event_id") % 50, path, F.lit("0"), F.array(one), nothing),
        hit("EVENT", F.lit(100) + F.col("event_id") % 50, path, action, F.array_compact(F.array(one, two)), sale),
    )
    day = F.date_format("ts", "yyyyMMdd")
    return e.select(
        F.concat(F.lit("v"), user).alias("fullVisitorId"),
        F.col("event_id").alias("visitId"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("visitStartTime"),
        day.alias("date"),
        day.alias("table_suffix"),
        F.struct(
            _numbered("Continent ", 5).alias("continent"), _numbered("Country ", 25).alias("country"),
            _numbered("Region ", 40).alias("region"), F.lit(None).cast("string").alias("metro"),
            _numbered("City ", 60).alias("city"), _numbered("net", 8).alias("networkDomain"),
        ).alias("geoNetwork"),
        F.struct(
            F.concat(F.lit("device"), F.col("event_id") % 3).alias("deviceCategory"),
            _numbered("OS ", 4).alias("operatingSystem"),
            F.struct(
                _numbered("mb", 3).alias("mobileDeviceBranding"), _numbered("mm", 5).alias("mobileDeviceModel"),
                _numbered("mi", 2).alias("mobileInputSelector"), F.lit(None).cast("string").alias("mobileDeviceMarketingName"),
            ).alias("mobileDeviceInfo"),
        ).alias("device"),
        F.struct(
            _numbered("src", 4).alias("source"), _numbered("med", 3).alias("medium"), _numbered("cmp", 2).alias("campaign"),
            _numbered("kw", 9).alias("keyword"), _numbered("/ref/", 6).alias("referralPath"),
        ).alias("trafficSource"),
        F.struct(
            F.lit(1).cast("long").alias("visits"), (k % 3 + 1).cast("long").alias("pageviews"),
            F.when(kind == "error", F.lit(1).cast("long")).alias("bounces"),
            F.when(sold, F.lit(1).cast("long")).alias("transactions"),
            F.when(sold, F.col("micros") * 2).alias("transactionRevenue"),
        ).alias("totals"),
        hits.alias("hits"),
    )


# --- trips ----------------------------------------------------------------------------


def taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its order as trips of suppliers (taxis)."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    taxi, quantity = F.col("l_suppkey"), F.col("l_quantity")
    company = F.element_at(
        F.array(*[F.lit(c) for c in ("Flash Cab Co", "Checker Taxi", "Yellow Cab", "Medallion Inc", "City Taxi")]),
        (taxi % 5).cast("int") + 1,
    )
    payment = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Credit Card"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Cash"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Mobile"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("Dispute"))
    )
    pickup, dropoff = F.col("o_custkey") % 80, F.col("l_partkey") % 80
    pickup = F.when((pickup > 0) & (pickup < 78), pickup)
    dropoff = F.when((dropoff > 0) & (dropoff < 78), dropoff)
    fare, tips = quantity * 1.25, F.col("l_discount") * 50.0
    tolls, extras = F.col("l_tax") * 10.0, (F.col("l_linenumber") % 3) * 0.5
    hours = F.make_dt_interval(F.lit(0), (F.col("l_partkey") % 24).cast("int"))
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("T"), taxi).alias("taxi_id"),
        company.alias("company"),
        (F.col("l_shipdate") + hours).alias("trip_start_timestamp"),
        (quantity / 4).alias("trip_miles"),
        (F.col("l_partkey") % 3600 + 60).alias("trip_seconds"),
        fare.alias("fare"), tips.alias("tips"), tolls.alias("tolls"), extras.alias("extras"),
        (fare + tips + tolls + extras).alias("trip_total"),
        payment.alias("payment_type"),
        pickup.alias("pickup_community_area"), dropoff.alias("dropoff_community_area"),
        (F.lit(41.5) + pickup * 0.005).alias("pickup_latitude"), (F.lit(-87.9) + pickup * 0.004).alias("pickup_longitude"),
        (F.lit(41.5) + dropoff * 0.005).alias("dropoff_latitude"), (F.lit(-87.9) + dropoff * 0.004).alias("dropoff_longitude"),
    )


# --- trends ---------------------------------------------------------------------------


def _rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, nation, part = (table(spark, sf_dir, t) for t in ("customer", "nation", "part"))
    joined = (
        line.join(orders, line.l_orderkey == orders.o_orderkey).join(part, line.l_partkey == part.p_partkey)
        .join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    )
    words = F.array(*[F.lit(w) for w in ("google ", "how to ", "local news ", "buy ", "", "", "")])
    cities = F.array(*[F.lit(w) for w in ("New York ", "Los Angeles ", "Chicago ", "Dallas ", "")])
    return joined.select(
        F.col("n_nationkey").cast("long").alias("dma_id"),
        F.concat(F.element_at(cities, F.col("n_nationkey") % 5 + 1), F.col("n_name")).alias("dma_name"),
        F.col("n_name").alias("country_name"),
        F.concat(F.element_at(words, (F.col("l_partkey") % 7).cast("int") + 1), F.col("p_name")).alias("term"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("week"),
        F.to_date("o_orderdate").alias("refresh_date"),
        (F.lit(1) + (F.col("l_linenumber") + F.col("l_partkey")) % 25).alias("rank"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * 2).alias("score"),
        (F.col("n_regionkey") == 1).alias("domestic"),
        (F.col("l_discount") >= 0.08).alias("rising"),
    )


def trend_tables(
    spark: SparkSession, sf_dir: str, store: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Domestic and international rankings, and the same for rising terms."""
    rows = _rankings(spark, sf_dir)
    if store:
        rows = materialize(rows)
    home = rows.where("domestic").drop("country_name")
    abroad = rows.where("NOT domestic").drop("dma_id", "dma_name")
    return home, abroad, home.where("rising"), abroad.where("rising")
