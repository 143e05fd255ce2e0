"""Controlled damage to an event table, reproducible row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.config import PROVINCES, SEED, DegradeConfig
from recprep.functions.hashing import digest, draw_below, pick, quarter, row_key, u01, unit
from recprep.functions.numeric import clamp
from recprep.operators.keyed import best_row
from recprep.operators.ranks import weighted_pick
from recprep.operators.sampling import Cut, hash_cut, in_cut
from recprep.session import materialize
from recprep.sources.events import to_event_schema

NULL_SALT = "null-item"
COLD_SALT = "cold-item"
JITTER_SALT = "jitter"
CART_SALT = "cart"
# --- Fixed values: what a bot's events look like. ---
EVENTS_PER_BOT = 200
BOT_PREFIX = "bot_"
BOT_VALUES = {"event_type": "view", "device_category": "desktop", "discount_flag": False}
# --- End of fixed values. ---
POPULARITY_UNITS = 1e6  # weights are whole numbers: their totals do not depend on order


# --- missing attributes ---------------------------------------------------------------


def _is_null_item(rate: float, seed: int) -> Column:
    return draw_below(rate, seed, NULL_SALT, F.col("item_id"))


def null_item_attributes(events: DataFrame, rate: float, seed: int = SEED) -> DataFrame:
    """Blank category_code and brand on every row of about ``rate`` of the items."""
    hit = _is_null_item(rate, seed)
    blank = {c: F.when(hit, F.lit(None)).otherwise(F.col(c)) for c in ("category_code", "brand")}
    return events.withColumns({c: e for c, e in blank.items() if c in events.columns})


def null_items(events: DataFrame, rate: float, seed: int = SEED) -> DataFrame:
    """The items that ``null_item_attributes`` blanks."""
    return events.where(_is_null_item(rate, seed)).select("item_id").distinct()


# --- cold items -----------------------------------------------------------------------


def cold_item_cut(events: DataFrame, rate: float, seed: int = SEED) -> Cut | None:
    """Where the cold sample ends in hash order; runs a job over the distinct items."""
    items = events.select("item_id").where(F.col("item_id").isNotNull()).distinct()
    # half-even, as Python's round
    return hash_cut(items, "item_id", lambda n: F.bround(F.lit(rate) * n), seed, COLD_SALT)


def hold_out_cold_items(
    events: DataFrame,
    rate: float,
    seed: int = SEED,
    tie: Column | None = None,
    cut_from: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cold ids, warm events, cold catalog): exactly round(rate * items) items are held out.

    Membership is a comparison with the sample's cut position, so splitting the events needs
    no join. Rows without an item are in neither part. The catalog has one row per cold item,
    the earliest (ties: ``tie``, default a hash of the row). ``cut_from`` is a cheaper table
    with the same items, if there is one.
    """
    source = events if cut_from is None else cut_from
    cold = is_cold(cold_item_cut(source, rate, seed), seed)
    warm = events.where(F.col("item_id").isNotNull() & ~cold)
    keyed = events.where(cold).withColumn("_tie", row_key(events) if tie is None else tie)
    return source.where(cold).select("item_id").distinct(), warm, first_of_item(keyed, "_tie").drop("_tie")


def is_cold(cut: Cut | None, seed: int = SEED) -> Column:
    """Is the row's item in the cold sample?"""
    return in_cut("item_id", cut, seed, COLD_SALT)


def first_of_item(events: DataFrame, tie: str) -> DataFrame:
    """The earliest row of each item."""
    return best_row(events, ["item_id"], [F.col("event_time").asc_nulls_last(), F.col(tie)])


# --- late timestamps ------------------------------------------------------------------


def _exponential(draw: Column, rate_per_s: float) -> Column:
    """Milliseconds with mean 1000/rate, from a uniform draw."""
    return -F.log(F.lit(1.0) - draw) * F.lit(1000.0) / F.lit(float(rate_per_s))


def _moved(time: Column | str, ms: Column) -> Column:
    """A timestamp some milliseconds later; days go apart, since the function takes an INT, which ends at 24.8 days."""
    day = 86_400_000
    later = F.timestamp_add("DAY", F.floor(ms / day).cast("int"), time if isinstance(time, Column) else F.col(time))
    return F.timestamp_add("MILLISECOND", F.pmod(ms, F.lit(day)).cast("int"), later)


def jitter_event_time(
    events: DataFrame, rate_per_s: float, seed: int = SEED, key: Column | None = None
) -> DataFrame:
    """Delay each event by floor(Exp(mean 1000/rate ms)); the old time is ``true_event_time``."""
    draw = u01(seed, JITTER_SALT, row_key(events) if key is None else key)
    delay = F.floor(_exponential(draw, rate_per_s))
    kind = events.schema["event_time"].dataType.simpleString()
    if kind in ("timestamp", "timestamp_ntz"):
        moved = _moved("event_time", delay)
    else:
        moved = F.col("event_time") + delay
    return events.withColumn("true_event_time", F.col("event_time")).withColumn("event_time", moved)


# --- lost cart events -----------------------------------------------------------------


def drop_pre_purchase_carts(
    events: DataFrame, rate: float, seed: int = SEED, key: Column | None = None, store: bool = False
) -> DataFrame:
    """Lose about ``rate`` of the cart events that a purchase of the same item follows.

    Same item means same (user, item, session), NULLs equal. The coin is tossed first, so
    only the unlucky carts (``rate`` of the carts) and the last purchase per group meet in a
    join; all other events pass through untouched and unshuffled. ``store`` writes the few
    unlucky carts that survive, so that later passes over the result are plain scans.
    """
    group = ["user_id", "item_id", "user_session"]
    columns = events.columns
    toss = draw_below(rate, seed, CART_SALT, row_key(events) if key is None else key)
    unlucky = F.coalesce((F.col("event_type") == "cart") & toss, F.lit(False))
    # texts that no NULL shares, so that groups and join meet in one shuffle
    same = {f"_{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in group}
    bought = (
        events.where(F.col("event_type") == "purchase")
        .groupBy(*[text.alias(name) for name, text in same.items()])
        .agg(F.max("event_time").alias("_last_buy"))
    )
    suspects = events.where(unlucky).withColumns(same).join(bought, list(same), "left")
    spared = suspects.where(F.coalesce(F.col("_last_buy") <= F.col("event_time"), F.lit(True)))
    spared = spared.select(*columns)
    return events.where(~unlucky).unionByName(materialize(spared) if store else spared)


# --- bot traffic ----------------------------------------------------------------------


def append_bot_traffic(
    events: DataFrame,
    fraction: float,
    rate_per_s: float,
    gap_min_ms: int,
    gap_max_ms: int,
    provinces: tuple[str, ...] = PROVINCES,
    seed: int = SEED,
) -> DataFrame:
    """Append int(fraction * rows) rapid views by bots, without user or session.

    A bot makes 200 events (the last one also the remainder), a few ms apart from the first
    event time on. Items are drawn by popularity^0.75. One row of facts (event count, first
    time, item count, total weight) goes to the driver to size the range of new rows. Counts
    per item are written once; pass a table that is already written when recomputing
    ``events`` is expensive.
    """
    flood = bot_traffic(events, fraction, rate_per_s, gap_min_ms, gap_max_ms, provinces, seed)
    return events if flood is None else events.unionByName(flood, allowMissingColumns=True)


def bot_traffic(
    events: DataFrame,
    fraction: float,
    rate_per_s: float,
    gap_min_ms: int,
    gap_max_ms: int,
    provinces: tuple[str, ...] = PROVINCES,
    seed: int = SEED,
) -> DataFrame | None:
    """Only the bot rows; None when the fraction comes to no row."""
    per_item = events.groupBy("item_id").agg(F.count("*").alias("n"), F.min("event_time").alias("t0"))
    weight = F.rint(F.pow(F.col("n"), F.lit(0.75)) * POPULARITY_UNITS).cast("long")
    weighed = materialize(per_item.withColumn("w", F.when(F.col("item_id").isNotNull(), weight)))
    facts = weighed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min("t0").alias("t0"),
        F.count("w").alias("items"),
        F.sum("w").alias("total"),
    ).first()
    n_bot = int(fraction * facts["n"]) if facts["items"] else 0
    if n_bot == 0:
        return None
    last_bot = max(n_bot // EVENTS_PER_BOT, 1) - 1
    events_each = n_bot // (last_bot + 1)  # the last bot also makes what is left over

    rows = events.sparkSession.range(n_bot).withColumnRenamed("id", "_i").withColumns({
        "_bot": F.least(F.floor(F.col("_i") / events_each), F.lit(last_bot)),
        "_d": digest(seed, "bot-event", F.col("_i")),
    })
    gap = F.floor(clamp(_exponential(quarter(F.col("_d"), 2), rate_per_s), gap_min_ms, gap_max_ms))
    per_bot_so_far = Window.partitionBy("_bot").orderBy("_i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    timed = rows.select(
        "_i",
        "_bot",
        unit(F.col("_d")).alias("_u"),
        (F.lit(1) + F.floor(quarter(F.col("_d"), 3) * 9)).cast("long").alias("engagement_time_msec"),
        F.sum(gap).over(per_bot_so_far).alias("_offset"),
    )
    popular = weighed.where(F.col("w").isNotNull()).select("item_id", "w")
    picked = weighted_pick(timed, "_u", popular, "item_id", "w", facts["total"], facts["items"])
    time_type = events.schema["event_time"].dataType
    if time_type.simpleString() in ("timestamp", "timestamp_ntz"):
        start = F.lit(facts["t0"]).cast(time_type)
        event_time = _moved(start, F.col("_offset"))
    else:
        event_time = F.lit(facts["t0"] or 0) + F.col("_offset")
    stamped = time_type.simpleString() in ("timestamp", "timestamp_ntz")
    values = {name: F.lit(value) for name, value in BOT_VALUES.items()} | {
        "item_id": F.col("item_id"),
        "event_time": F.lit(None) if stamped else event_time,
        "engagement_time_msec": F.col("engagement_time_msec"),
        "geo_province": pick(u01(seed, "bot", F.col("_bot")), tuple(provinces)),
        "user_pseudo_id": F.concat(F.lit(f"{BOT_PREFIX}{seed}_"), F.col("_bot").cast("string")),
    }
    made = to_event_schema(picked.withColumn("true_event_time", event_time), values, ("true_event_time",))
    if stamped:
        made = made.withColumn("event_time", F.col("true_event_time"))
    return made.select(*[c for c in made.columns if c in events.columns or c == "true_event_time"])


# --- all of it ------------------------------------------------------------------------


def degrade_human_events(
    events: DataFrame,
    cfg: DegradeConfig = DegradeConfig(),
    seed: int = SEED,
    key: Column | str | None = None,
    items_from: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Everything but the bots: (events, cold ids, null items, cold catalog).

    The steps that look at one row (blank, cold or not, delay) are one projection. It is
    written once, with cold items in a partition of their own, and the catalog and the cart
    step read it. ``items_from``: a cheaper table with the same items (the source before
    enrichment, say). A ``key`` that is the name of a column is not stored a second time.
    """
    source = events if items_from is None else items_from  # rows or distinct items
    cold = is_cold(cold_item_cut(source, cfg.cold_item_rate, seed), seed)
    row = key if isinstance(key, str) else "_row"
    keyed = events
    if not isinstance(key, str):
        keyed = events.withColumn(row, row_key(events) if key is None else key)
    blanked = null_item_attributes(keyed, cfg.null_item_rate, seed)
    late = jitter_event_time(blanked, cfg.jitter_rate_per_s, seed, F.col(row))
    columns = events.columns
    stored = materialize(late.withColumn("_cold", cold), ("_cold",))
    warm = stored.where(~F.col("_cold") & F.col("item_id").isNotNull()).drop("_cold")
    kept = drop_pre_purchase_carts(warm, cfg.cart_drop_rate, seed, F.col(row), store=True)
    on_time = stored.where(F.col("_cold")).withColumn("event_time", F.col("true_event_time"))
    catalog = first_of_item(on_time, row).select(*columns)
    return (
        kept.select(*columns, "true_event_time"),
        source.where(cold).select("item_id").distinct(),
        null_items(source, cfg.null_item_rate, seed),
        catalog,
    )


def degrade_all(
    events: DataFrame,
    cfg: DegradeConfig = DegradeConfig(),
    provinces: tuple[str, ...] = PROVINCES,
    seed: int = SEED,
    key: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Blank attributes, hold out cold items, delay, lose carts, add bots - in this order."""
    human, cold, lost_items, catalog = degrade_human_events(events, cfg, seed, key)
    flooded = append_bot_traffic(
        human, cfg.bot_fraction, cfg.bot_rate_per_s, cfg.bot_gap_min_ms, cfg.bot_gap_max_ms, provinces, seed
    )
    return flooded, cold, lost_items, catalog
