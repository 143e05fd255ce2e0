"""Portable randomness: a draw is a function of (seed, salt, key), never of row order.

The same row gets the same draw in any engine that has MD5, under any partitioning, and
again when a lost task is retried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT = float(1 << 52)  # 13 hex digits: exact in a double, so u is in [0, 1) and 1 - u > 0
_QUARTER = float(1 << 32)


def digest(seed: int, salt: str, *keys: Column) -> Column:
    """MD5 hex of ``seed|salt|key...``; NULL when any key is NULL."""
    return F.md5(F.concat(F.lit(f"{seed}|{salt}"), *[_joined(k) for k in keys]))


def _joined(key: Column) -> Column:
    return F.concat(F.lit("|"), key.cast("string"))


def unit(hex_digest: Column) -> Column:
    """Uniform draw in [0, 1) from the first 13 hex digits of a digest."""
    return F.conv(F.substring(hex_digest, 1, 13), 16, 10).cast("double") / F.lit(_UNIT)


def quarter(hex_digest: Column, index: int) -> Column:
    """One of four independent 32-bit draws in [0, 1) from a single digest (index 0..3)."""
    piece = F.substring(hex_digest, 1 + 8 * index, 8)
    return F.conv(piece, 16, 10).cast("double") / F.lit(_QUARTER)


def u01(seed: int, salt: str, *keys: Column) -> Column:
    """Uniform draw in [0, 1) per key."""
    return unit(digest(seed, salt, *keys))


def _position(u: float) -> str:
    """The first 13 hex digits at which draws reach ``u`` in (0, 1)."""
    return f"{math.ceil(u * _UNIT):013x}"


def draw_below(rate: float, seed: int, salt: str, *keys: Column) -> Column:
    """``u01(seed, salt, *keys) < rate`` by comparing text: digits of one width have the order of their numbers."""
    text = digest(seed, salt, *keys)
    if not 0 < rate <= 1 - 1 / _UNIT:
        return F.when(text.isNotNull(), F.lit(rate > 0))
    return text < F.lit(_position(rate))


def draw_upto(u: float, key: str, seed: int, salt: str, column: Column) -> Column:
    """(``u01(seed, salt, column)``, column) <= (``u``, ``key``) by one comparison of texts; ``u`` is a draw."""
    k = column.cast("string")
    return F.concat(F.substring(digest(seed, salt, column), 1, 13), k) <= F.lit(_position(u) + key)


def row_key(df: DataFrame) -> Column:
    """Key for a row without an id: 128 hash bits over all columns.

    Two 64-bit hashes read the columns in their binary form, which is many times cheaper than
    an MD5 over their text. Exact copies share one key, so they share each draw;
    ``operators.ordered.row_ids`` tells copies apart.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    return F.concat_ws("", F.hex(F.xxhash64(*names)), F.hex(F.xxhash64(F.lit("second"), *names)))


def pick(draw: Column, values: tuple, weights: tuple | None = None) -> Column:
    """Choose one literal by a uniform draw, weighted or evenly; NULL draw gives NULL."""
    if weights is None:
        index = F.floor(draw * F.lit(len(values))).cast("int") + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), index)
    total = float(sum(weights))
    running, chosen = 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        running += weight / total
        test = draw < F.lit(running)
        chosen = F.when(test, F.lit(value)) if chosen is None else chosen.when(test, F.lit(value))
    last = F.when(draw.isNotNull(), F.lit(values[-1]))
    return last if chosen is None else chosen.otherwise(last)
