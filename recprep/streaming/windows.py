"""Counts per time window and per session as events arrive, with a watermark that closes them.

The functions take a stream or a stored table. A stream in append mode writes a window once,
when the watermark (the latest event time seen, less the delay) has passed its end; events that
come later than that are left out. On a stored table the same function gives all windows, and
:func:`closed` picks those that a stream would have written by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(events: DataFrame, window: Column, delay: str, keys: list[str], time: str) -> DataFrame:
    known = events.withWatermark(time, delay) if events.isStreaming else events.where(F.col(time).isNotNull())
    counts = known.groupBy(window.alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, "n")


def window_counts(
    events: DataFrame, width: str, delay: str, keys: list[str], time: str = "event_at", slide: str | None = None
) -> DataFrame:
    """Events per window of ``width`` (every ``slide``, if given) and key."""
    return _counted(events, F.window(time, width, slide or width), delay, keys, time)


def session_counts(events: DataFrame, gap: str, delay: str, keys: list[str], time: str = "event_at") -> DataFrame:
    """Events per session of a key: a session ends ``gap`` after its last event."""
    return _counted(events, F.session_window(time, gap), delay, keys, time)


def closed(counts: DataFrame, events: DataFrame, delay: str, time: str = "event_at") -> DataFrame:
    """The windows of a stored table that a watermark over all its events has closed."""
    mark = events.agg((F.date_trunc("MILLISECOND", F.max(time)) - F.expr(f"INTERVAL {delay}")).alias("mark"))
    return counts.join(F.broadcast(mark), F.col("window_end") <= F.col("mark"), "left_semi")  # one row


def run_to_end(counts: DataFrame, out_path: str, checkpoint: str) -> None:
    """Process everything that has arrived since the last call, then stop; state and progress are kept in ``checkpoint``."""
    query = (
        counts.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path)
    )
    query.awaitTermination()


def as_ntz(counts: DataFrame) -> DataFrame:
    """Window bounds as wall time in UTC."""
    return counts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
