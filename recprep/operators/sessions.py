"""Session telemetry: dwell time, pseudo ids, device and province."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.config import (
    DEVICE_WEIGHTS,
    DEVICES,
    PROVINCE_WEIGHTS,
    PROVINCES,
    SEED,
)
from recprep.functions.hashing import digest, pick, quarter, row_key
from recprep.functions.numeric import clamp
from recprep.operators.skew import SplitPlan, next_in_group


def session_dwell(
    events: DataFrame,
    cap_ms: int,
    tie: Column | None = None,
    null_session: str = "isolate",
    split: SplitPlan | None = SplitPlan(),
) -> DataFrame:
    """Set ``engagement_time_msec``: time to the next event of the session, within [0, cap].

    The last event of a session gets 0, and so does an event without a time. Events at one
    instant follow ``tie`` (default: a hash of the row). Events without a session are not one
    giant session: they get 0 and are not shuffled (``null_session="isolate"``).
    ``"reference"`` treats them as a single session.
    """
    if null_session not in ("isolate", "reference"):
        raise ValueError("null_session is 'isolate' or 'reference'")
    columns = [c for c in events.columns if c != "engagement_time_msec"]
    keyed = events.select(*columns, (row_key(events) if tie is None else tie).alias("_tie"))
    in_session = F.col("event_time").isNotNull()
    group = F.col("user_session")
    if null_session == "isolate":
        in_session = in_session & group.isNotNull()
    else:
        group = F.coalesce(F.concat(F.lit("s"), group), F.lit("-"))
    inside = keyed.where(in_session).withColumn("_group", group)
    led = next_in_group(inside, "_group", ["event_time", "_tie"], "_next", split)
    gap = F.col("_next") - F.col("event_time")
    dwell = F.coalesce(clamp(gap, 0, cap_ms), F.lit(0)).cast("long").alias("engagement_time_msec")
    alone = events.where(~in_session).select(*columns, F.lit(0).cast("long").alias("engagement_time_msec"))
    out = led.select(*columns, dwell).unionByName(alone)
    order = events.columns if "engagement_time_msec" in events.columns else out.columns
    return out.select(*order)


def _pseudo_part(draw: Column) -> Column:
    low, high = 1_000_000_000, 9_999_999_999
    return (F.lit(low) + F.floor(draw * F.lit(high - low))).cast("string")


def assign_session_profile(
    events: DataFrame,
    seed: int = SEED,
    devices: tuple[str, ...] = DEVICES,
    device_weights: tuple[float, ...] = DEVICE_WEIGHTS,
    provinces: tuple[str, ...] = PROVINCES,
) -> DataFrame:
    """Give each session a pseudo id, device and province; values already there win.

    Everything is drawn from one digest of the session id, so this is a projection: no
    session table, no join. Rows without a session keep what they have.
    """
    if not provinces:
        raise ValueError("provinces must not be empty")
    weights = PROVINCE_WEIGHTS if len(provinces) == len(PROVINCE_WEIGHTS) else None
    draws = digest(seed, "session", F.col("user_session"))
    known = events.withColumn("_d", draws)
    d = F.col("_d")
    pseudo = F.concat_ws(".", _pseudo_part(quarter(d, 0)), _pseudo_part(quarter(d, 1)))
    values = {
        "user_pseudo_id": F.when(d.isNotNull(), pseudo),
        "device_category": pick(quarter(d, 2), tuple(devices), tuple(device_weights)),
        "geo_province": pick(quarter(d, 3), tuple(provinces), weights),
    }
    for name, value in values.items():
        current = F.col(name) if name in events.columns else F.lit(None).cast("string")
        known = known.withColumn(name, F.coalesce(current, value))
    return known.drop("_d")


def enrich_sessions(
    events: DataFrame,
    cap_ms: int,
    seed: int = SEED,
    tie: Column | None = None,
    null_session: str = "isolate",
    split: SplitPlan | None = SplitPlan(),
    **profile,
) -> DataFrame:
    """Session profile, then dwell."""
    profiled = assign_session_profile(events, seed, **profile)
    return session_dwell(profiled, cap_ms, tie, null_session, split)
