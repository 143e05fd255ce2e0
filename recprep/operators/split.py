"""User-level train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.config import SEED
from recprep.operators.sampling import hash_cut, in_cut
from recprep.session import materialize

SPLIT_SALT = "split"


def eligible_users(events: DataFrame, min_events: int) -> DataFrame:
    """Users with at least ``min_events`` rows; the missing user is not one."""
    counts = events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_events).select("user_id")


def test_users(
    events: DataFrame, test_fraction: float, min_events: int, seed: int = SEED, at_least_one: bool = False
) -> DataFrame:
    """Exactly int(test_fraction * eligible) users, chosen by hash."""
    eligible = eligible_users(events, min_events)
    cut = hash_cut(eligible, "user_id", _size(test_fraction, at_least_one), seed, SPLIT_SALT)
    return eligible.where(in_cut("user_id", cut, seed, SPLIT_SALT))


def _size(test_fraction: float, at_least_one: bool):
    def size(n):
        wanted = F.floor(F.lit(test_fraction) * n)
        if at_least_one and test_fraction > 0:
            return F.when((wanted == 0) & (n >= 2), F.lit(1)).otherwise(wanted)
        return wanted

    return size


def with_side(
    events: DataFrame,
    test_fraction: float,
    min_events: int,
    seed: int = SEED,
    null_users: str = "drop",
    at_least_one: bool = False,
) -> DataFrame:
    """Add ``side``: train, test, or NULL for rows that belong to neither.

    No user is on both sides, and users below ``min_events`` are in train. Rows without a user
    are in neither part (``null_users="drop"``) or in train (``"train"``). Eligible users are
    written once. Only users whose hash lies below the cut can be test users, so only that
    slice of the events meets the user list in a join.
    """
    if null_users not in ("drop", "train"):
        raise ValueError("null_users is 'drop' or 'train'")
    eligible = materialize(eligible_users(events, min_events))
    cut = hash_cut(eligible, "user_id", _size(test_fraction, at_least_one), seed, SPLIT_SALT)
    below = in_cut("user_id", cut, seed, SPLIT_SALT)
    chosen = eligible.where(below).select("user_id", F.lit("test").alias("side"))
    slice_ = events.where(below).join(chosen, "user_id", "left").withColumn("side", F.coalesce("side", F.lit("train")))
    unnamed = F.lit(None).cast("string") if null_users == "drop" else F.lit("train")
    rest = events.where(~below).withColumn("side", F.when(F.col("user_id").isNull(), unnamed).otherwise(F.lit("train")))
    return rest.unionByName(slice_)


def split_by_user(
    events: DataFrame,
    test_fraction: float,
    min_events: int,
    seed: int = SEED,
    null_users: str = "drop",
    at_least_one: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by :func:`with_side`."""
    sides = with_side(events, test_fraction, min_events, seed, null_users, at_least_one)
    train, test = (sides.where(F.col("side") == s).select(*events.columns) for s in ("train", "test"))
    return train, test
